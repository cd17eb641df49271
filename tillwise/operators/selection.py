"""Order statistics by boundary refinement: rows at given ranks, without
sorting or shuffling the table.

A rank's band of values starts as everything and is narrowed until it holds
few rows: one aggregate draws new borders from approximate percentiles inside
the band, another counts exactly how many rows lie below and inside them (the
borders may be wrong, the counts are not: a band that misses its rank keeps
its old border). A round divides a band by some thousands. What is left is
ordered inside its band: at most ``max_band`` rows in a task. A single value
that more rows share needs no order unless ties are broken by a key; then
only those tied rows are sorted, by key, over range partitions.

All bands of all columns advance together, so the number of jobs does not
depend on the number of ranks. The driver sees counts and the rows asked for.
Values are doubles without NaN; NULL values are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import global_index

MAX_BAND = 200_000
ACCURACY = 10_000
INF = float("inf")


@dataclass
class Band:
    """Rows of one column with ``lo <= value <= hi``; ``below`` rows are smaller."""
    name: str
    ranks: list[int]
    below: int = 0
    inside: int = 0
    lo: float = -INF
    hi: float = INF
    found: dict[int, tuple] = field(default_factory=dict)

    def column(self, value: Column) -> Column:
        return (value >= F.lit(self.lo)) & (value <= F.lit(self.hi))

    def open(self, max_band: int) -> bool:
        return self.inside > max_band and self.lo < self.hi


def at_ranks(df: DataFrame, columns: dict[str, Column], ranks: Callable[[str, int], Sequence[int]], key: str | None = None,
             max_band: int = MAX_BAND) -> dict[str, tuple[int, dict[int, tuple]]]:
    """Per name the number of values and, for the 0-based ranks that
    ``ranks(name, n)`` asks for, the (value, key) found there, in ascending
    order of value and then key (key None: values only). ``df`` is read a few
    times; pass a written table."""
    sizes = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns.values())]).collect()[0]
    count = {name: sizes[f"n{i}"] for i, name in enumerate(columns)}
    bands = []
    for name, n in count.items():
        wanted = sorted({r for r in ranks(name, n) if 0 <= r < n})
        if n <= max_band:
            bands += [Band(name, wanted, 0, n)] if wanted else []
        else:
            bands += [Band(name, [r], 0, n) for r in wanted]
    while live := [b for b in bands if b.open(max_band)]:
        if not _narrow(df, columns, live):
            break
    _read(df, columns, [b for b in bands if b.lo < b.hi or key], key, max_band)
    for b in bands:
        if b.lo == b.hi and not key:
            b.found = {r: (b.lo, None) for r in b.ranks}
    return {name: (n, {r: v for b in bands if b.name == name for r, v in b.found.items()}) for name, n in count.items()}


def _narrow(df: DataFrame, columns: dict[str, Column], live: list[Band]) -> bool:
    """New borders for each band; False if none got smaller."""
    asks = []
    for i, b in enumerate(live):
        p = (b.ranks[0] - b.below + 0.5) / b.inside
        edge = 2.0 / ACCURACY
        inner = F.when(b.column(columns[b.name]), columns[b.name])
        asks.append(F.percentile_approx(inner, [max(0.0, p - edge), p, min(1.0, p + edge)], ACCURACY).alias(f"p{i}"))
        asks += [F.min(inner).alias(f"a{i}"), F.max(inner).alias(f"b{i}")]
    row = df.agg(*asks).collect()[0]
    counts, tried = [], []
    for i, b in enumerate(live):
        v = columns[b.name]
        lo, mid, hi = row[f"p{i}"]
        low, high = row[f"a{i}"], row[f"b{i}"]
        options = [(lo, hi), (mid, mid), (low, high)]
        tried.append(options)
        for j, (x, y) in enumerate(options):
            counts += [F.count_if(v < F.lit(x)).alias(f"l{i}_{j}"), F.count_if((v >= F.lit(x)) & (v <= F.lit(y))).alias(f"c{i}_{j}")]
    got = df.agg(*counts).collect()[0]
    smaller = False
    for i, b in enumerate(live):
        fits = [(got[f"c{i}_{j}"], got[f"l{i}_{j}"], x, y) for j, (x, y) in enumerate(tried[i])
                if got[f"l{i}_{j}"] <= b.ranks[0] < got[f"l{i}_{j}"] + got[f"c{i}_{j}"]]
        inside, below, lo, hi = min(fits, key=lambda f: (f[0], f[3] - f[2]))      # (low, high) always fits
        if (inside, hi - lo) < (b.inside, b.hi - b.lo):
            b.inside, b.below, b.lo, b.hi = inside, below, lo, hi
            smaller = True
    return smaller


def _read(df: DataFrame, columns: dict[str, Column], bands: list[Band], key: str | None, max_band: int) -> None:
    small = [b for b in bands if b.inside <= max_band]
    k = F.col(key) if key else F.lit(None).cast("string")
    if small:
        hits = F.array(*[F.when(b.column(columns[b.name]), F.struct(F.lit(i).alias("b"), columns[b.name].alias("v"), k.alias("k"))) for i, b in enumerate(small)])
        rows = df.select(F.explode(hits).alias("h")).where(F.col("h").isNotNull()).select("h.*")
        ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("v", "k")) - 1)      # at most max_band rows a band
        wanted = F.lit(False)
        for i, b in enumerate(small):
            wanted = wanted | ((F.col("b") == i) & F.col("r").isin([r - b.below for r in b.ranks]))
        for row in ranked.where(wanted).collect():                                                          # the rows asked for
            b = small[row["b"]]
            b.found[row["r"] + b.below] = (row["v"], row["k"])
    for b in bands:
        if b.inside > max_band:
            tied = df.where(b.column(columns[b.name])).select(columns[b.name].alias("v"), k.alias("k"))
            at = global_index(tied, ["v", "k"], "r", "n")
            for row in at.where(F.col("r").isin([r - b.below for r in b.ranks])).collect():
                b.found[row["r"] + b.below] = (row["v"], row["k"])


def ntile_starts(n: int, buckets: int) -> list[int]:
    """Ranks at which the NTILE buckets 2, 3, .. start (past n if empty)."""
    size, more = divmod(n, buckets)
    return [i * size + min(i, more) for i in range(1, buckets)]


def bucket(value: Column, key: str, starts: Sequence[tuple]) -> Column:
    """1 + the number of starts (value, key) at or before the row."""
    out = F.lit(1)
    for v, k in starts:
        out = out + ((value > F.lit(v)) | ((value == F.lit(v)) & (F.col(key) >= F.lit(k)))).cast("int")
    return out


def interpolated(found: dict[int, tuple], n: int, p: float) -> float | None:
    """``PERCENTILE_CONT(p)`` from the rows at ``around(n, p)``."""
    if not n:
        return None
    lo, hi = around(n, p)
    a, b = found[lo][0], found[hi][0]
    return a + (b - a) * (p * (n - 1) - lo)


def around(n: int, p: float) -> list[int]:
    at = p * (n - 1)
    return [int(at), min(n - 1, int(at) + (at > int(at)))]


def quantiles(df: DataFrame, columns: Sequence[str], p: float = 0.5, max_band: int = MAX_BAND) -> dict[str, float | None]:
    """The exact interpolated quantile of each column, NULLs left out."""
    got = at_ranks(df, {c: F.col(c).cast("double") for c in columns}, lambda _, n: around(n, p) if n else [], None, max_band)
    return {c: interpolated(found, n, p) for c, (n, found) in got.items()}
