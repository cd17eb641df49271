"""Column expressions shared by the marts (all JVM-side, codegen friendly).

Money is summed as DECIMAL and only cast to DOUBLE at the output. Rounded
averages and ratios use exact integer half-up rounding so the result does not
depend on how an engine represents an intermediate quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(22,2)"
PRICE = "decimal(24,10)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN TRUE ELSE FALSE END``: NULL becomes FALSE."""
    return F.coalesce(cond, F.lit(False))


def int_flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` as an integer."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed whole days from ``start`` to ``end`` (``DATEDIFF(day, a, b)``):
    23:00 to 01:00 two calendar days later counts 1."""
    return F.timestamp_diff("DAY", col(start), col(end))


def exact_amount(quantity: str | Column, unit_price: str | Column) -> Column:
    """``Quantity * UnitPrice`` as a DECIMAL with ten decimals; NULL (not an
    aborted job) for a price of 1e14 or more."""
    return col(quantity).cast("decimal(10,0)") * col(unit_price).try_cast(PRICE)


def line_total(quantity: str | Column, unit_price: str | Column) -> Column:
    """``ROUND(Quantity * UnitPrice, 2)`` computed in DECIMAL (half-up). An
    amount beyond MONEY is NULL, which the not_null data test counts."""
    return F.round(exact_amount(quantity, unit_price), 2).try_cast(MONEY)


def cents(amount: str | Column) -> Column:
    """A 2-decimal DECIMAL amount as whole cents (LONG)."""
    return (col(amount) * F.lit(100)).cast(_INT)


_INT = "decimal(38,0)"


def _idiv(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative integers (a DECIMAL quotient
    would be cut to six decimals before its floor)."""
    return F.call_function("div", a.cast(_INT), b.cast(_INT))


def half_up_div(numerator_hundredths: str | Column, denominator: str | Column) -> Column:
    """``ROUND(n / d, 2)`` for n >= 0 given in hundredths (cents), d > 0.

    Exact: ``(2n + d) div 2d`` is the half-up rounded quotient in hundredths.
    NULL when d is 0 or NULL (the ``NULLIF(d, 0)`` guard).
    """
    n = col(numerator_hundredths).cast(_INT)
    d = F.nullif(col(denominator).cast(_INT), F.lit(0).cast(_INT))
    return _idiv(n * 2 + d, d * 2).cast("double") / F.lit(100.0)


def of_share(share: tuple[int, int] | None, *keys: str) -> Column:
    """Whether the keys of a row fall to part i of n, ``share`` (i, n); without
    it all do. Another hash than the one that deals rows in shuffles, so each
    part reaches all their partitions."""
    return F.lit(True) if share is None else F.pmod(F.xxhash64(*keys), F.lit(share[1])) == share[0]


def clamp(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """``clip``: least/greatest around a column."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return out
