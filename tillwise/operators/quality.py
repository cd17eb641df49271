"""Declarative data tests: not_null, unique, accepted_values, accepted_range,
relationships.

Failures are counted the way the tests' failing-row queries count them:
rows for not_null and accepted_range (NULLs never fail a range), distinct
offending values for accepted_values, duplicated values for unique. All
row-level tests of one table run in a single aggregate pass, or, where the
table is about to be written, ride on the write (``watch``) and cost no scan;
each unique test is one partial-aggregated grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import SEGMENTS, SUBSCRIPTION_TIERS


@dataclass(frozen=True)
class Check:
    column: str
    kind: str                      # not_null | unique | accepted_values | accepted_range
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None

    @property
    def args(self) -> str:
        if self.kind == "accepted_values":
            return ",".join(str(v) for v in self.values)
        if self.kind == "accepted_range":
            lo = "" if self.min_value is None else str(self.min_value)
            hi = "" if self.max_value is None else str(self.max_value)
            return f"[{lo},{hi}]"
        return ""


def nn(c):
    return Check(c, "not_null")


def uq(c):
    return Check(c, "unique")


def av(c, values):
    return Check(c, "accepted_values", tuple(values))


def rng(c, lo=None, hi=None):
    return Check(c, "accepted_range", (), lo, hi)


# The test suite of the reference models (57 tests).
SPECS: dict[str, list[Check]] = {
    "stg_transactions": [
        nn("InvoiceNo"), nn("StockCode"), nn("Quantity"), rng("Quantity", 1),
        nn("invoice_timestamp"), nn("UnitPrice"), rng("UnitPrice", 0.01), nn("CustomerID"),
        nn("line_total"), rng("line_total", 0.01),
    ],
    "stg_customers": [
        nn("CustomerID"), uq("CustomerID"), nn("subscription_tier"),
        av("subscription_tier", SUBSCRIPTION_TIERS), nn("monthly_fee"), rng("monthly_fee", 0),
        nn("churn_label"), av("churn_label", [0, 1]),
    ],
    "mart_customer_segments": [
        nn("CustomerID"), uq("CustomerID"), nn("recency_days"), nn("frequency"), rng("frequency", 1),
        nn("monetary"), rng("monetary", 0), nn("r_score"), rng("r_score", 1, 5), nn("f_score"),
        rng("f_score", 1, 5), nn("m_score"), rng("m_score", 1, 5), nn("customer_segment"),
        av("customer_segment", SEGMENTS), nn("business_priority"),
    ],
    "mart_clv_projections": [
        nn("CustomerID"), uq("CustomerID"), nn("frequency"), rng("frequency", 1), nn("recency"),
        rng("recency", 0), nn("T"), rng("T", 0), nn("monetary_value"), rng("monetary_value", 0),
    ],
    "mart_churn_risk": [
        nn("CustomerID"), uq("CustomerID"), nn("churn_label"), av("churn_label", [0, 1]),
        nn("total_transactions"), rng("total_transactions", 1), nn("total_spend"), rng("total_spend", 0),
        nn("recency_days"), rng("recency_days", 0), nn("tier_encoded"), rng("tier_encoded", 1, 4),
        nn("engagement_score"),
    ],
}


def _row_failure(check: Check):
    c = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "accepted_values":
        return F.count_distinct(F.when(~c.isin(*check.values), c))
    if check.kind == "accepted_range":
        cond = F.lit(False)
        if check.min_value is not None:
            cond = cond | (c < F.lit(check.min_value))
        if check.max_value is not None:
            cond = cond | (c > F.lit(check.max_value))
        return F.count_if(cond)
    raise ValueError(check.kind)


def watch(df: DataFrame, checks: list[Check] = ()) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its row count and row-level failures, which
    fills when the returned frame is written. Each output task counts its own
    rows once, also where tasks run again, so write the frame as it is (no
    shuffle or limit behind it)."""
    seen = Observation()
    fails = [F.count_if(~F.col(c.column).isin(*c.values)) if c.kind == "accepted_values" else _row_failure(c)
             for c in _row_checks(checks)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[f.alias(f"_{i}") for i, f in enumerate(fails)]), seen


def _row_checks(checks: list[Check]) -> list[Check]:
    return [c for c in checks if c.kind != "unique"]


def _watched_rows(df: DataFrame, table: str, row_checks: list[Check], found: dict) -> DataFrame:
    """The report's rows from what a write observed. Offending values are told
    apart by a pass over the written table, only if there are any."""
    offending = [c for i, c in enumerate(row_checks) if c.kind == "accepted_values" and found[f"_{i}"]]
    distinct = df.agg(*[_row_failure(c) for c in offending]).first() if offending else ()
    values = dict(zip(offending, distinct))
    rows = [(table, c.column, c.kind, c.args, int(values.get(c, found[f"_{i}"]))) for i, c in enumerate(row_checks)]
    return SparkSession.active().createDataFrame(     # a row per check
        rows, "table_name string, column_name string, test_name string, test_args string, failures long")


def run_checks(df: DataFrame, table: str, checks: list[Check], seen: Observation | None = None) -> DataFrame:
    """One row per check: table_name, column_name, test_name, test_args,
    failures, passed. ``seen``: the observation of the write of ``df``."""
    row_checks = _row_checks(checks)
    found = seen.get if seen is not None and row_checks else {}   # an empty plan may leave nothing observed
    parts = []
    if found:
        parts.append(_watched_rows(df, table, row_checks, found))
    elif row_checks:
        wide = df.agg(*[_row_failure(c).cast("long").alias(f"_{i}") for i, c in enumerate(row_checks)])
        meta = F.array(*[F.struct(F.lit(f"_{i}").alias("k"), F.lit(c.column).alias("column_name"),
                                  F.lit(c.kind).alias("test_name"), F.lit(c.args).alias("test_args"))
                         for i, c in enumerate(row_checks)])
        vals = F.create_map(*[x for i in range(len(row_checks)) for x in (F.lit(f"_{i}"), F.col(f"_{i}"))])
        long = wide.select(vals.alias("_vals"), F.explode(meta).alias("_m"))
        parts.append(long.select(F.lit(table).alias("table_name"), "_m.column_name", "_m.test_name",
                                 "_m.test_args", F.element_at("_vals", F.col("_m.k")).alias("failures")))
    for c in checks:
        if c.kind != "unique":
            continue
        dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") > 1).agg(F.count(F.lit(1)).cast("long").alias("failures")))
        parts.append(dup.select(F.lit(table).alias("table_name"), F.lit(c.column).alias("column_name"),
                                F.lit("unique").alias("test_name"), F.lit("").alias("test_args"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def dq_report(tables: dict[str, DataFrame], specs: dict[str, list[Check]] = SPECS,
              seen: dict[str, Observation] | None = None) -> DataFrame:
    """Quality report over several tables (one row per test). ``seen``: what
    was observed while tables were written (see ``watch``)."""
    out = None
    for name, checks in specs.items():
        if name not in tables:
            continue
        r = run_checks(tables[name], name, checks, (seen or {}).get(name))
        out = r if out is None else out.unionByName(r)
    return out


def relationships(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None,
                  child_name: str = "child", parent_name: str = "parent") -> DataFrame:
    """Referential check: child keys missing in the parent (left anti join)."""
    pc = parent_column or column
    keys = parent.select(F.col(pc).alias("_k")).distinct()
    missing = (child.where(F.col(column).isNotNull())
                    .join(keys, F.col(column) == F.col("_k"), "left_anti")
                    .agg(F.count(F.lit(1)).cast("long").alias("failures")))
    return missing.select(F.lit(child_name).alias("table_name"), F.lit(column).alias("column_name"),
                          F.lit("relationships").alias("test_name"), F.lit(f"{parent_name}.{pc}").alias("test_args"),
                          "failures", (F.col("failures") == 0).alias("passed"))
