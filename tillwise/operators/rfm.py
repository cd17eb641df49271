"""Gold mart: recency / frequency / monetary segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import cents, days_between, half_up_div
from ..params import SegmentParams
from ..session import cut_lineage
from . import selection
from .activity import last_clean
from .silver import observation_end_value

SEGMENT_COLUMNS = [
    "CustomerID", "recency_days", "frequency", "monetary", "total_line_items",
    "avg_line_value", "last_purchase_date", "first_purchase_date",
    "customer_lifespan_days", "r_score", "f_score", "m_score", "rfm_score",
    "rfm_segment_code", "customer_segment", "is_whale", "business_priority",
]


def anchor_value(silver: DataFrame, anchor: str | None) -> Column:
    """Recency anchor: observation end (default, a scalar subquery), the
    current date (``"current_date"``, the original choice) or a fixed
    timestamp."""
    if anchor is None:
        return observation_end_value(silver)
    if anchor == "current_date":
        return F.current_date().cast("timestamp")
    return F.lit(anchor).cast("timestamp")


def customer_metrics(silver: DataFrame | None, anchor: str | None = None, activity: DataFrame | None = None) -> DataFrame:
    """Per-customer base: one partial-aggregated pass over the silver lines, or
    taken from ``activity``, what ``customer_activity`` made of them (written).

    A customer holding a third of all lines costs nothing extra: every
    aggregate is combined map-side before the shuffle on CustomerID.
    """
    if activity is None:
        agg = silver.groupBy("CustomerID").agg(
            F.max("invoice_timestamp").alias("last_purchase_date"),
            F.min("invoice_timestamp").alias("first_purchase_date"),
            F.count_distinct("InvoiceNo").alias("frequency"),
            F.sum("line_total").alias("_spend"),
            F.count(F.lit(1)).alias("total_line_items"),
        )
    else:
        agg = activity.where(F.col("clean_lines") > 0).select(
            "CustomerID", F.col("clean_last").alias("last_purchase_date"), F.col("clean_first").alias("first_purchase_date"),
            F.col("clean_invoices").alias("frequency"), F.col("clean_spend").alias("_spend"),
            F.col("clean_lines").alias("total_line_items"))
    at = last_clean(activity).scalar() if anchor is None and activity is not None else anchor_value(silver, anchor)
    return (agg
            .select(
                "CustomerID",
                days_between(F.col("last_purchase_date"), at).cast("long").alias("recency_days"),
                F.col("frequency").cast("long").alias("frequency"),
                F.col("_spend").cast("double").alias("monetary"),
                F.col("total_line_items").cast("long").alias("total_line_items"),
                half_up_div(cents("_spend"), "total_line_items").alias("avg_line_value"),
                "last_purchase_date", "first_purchase_date",
                days_between("first_purchase_date", "last_purchase_date").cast("long")
                .alias("customer_lifespan_days"),
            ))


def _direction(c: str, ascending: bool) -> Column:
    return F.col(c).asc() if ascending else F.col(c).desc()


def rfm_segments(silver: DataFrame | None, p: SegmentParams = SegmentParams(),
                 max_band: int = selection.MAX_BAND, activity: DataFrame | None = None) -> DataFrame:
    """RFM scores (NTILE into ``p.buckets``), segment, priority and whale flag.

    ``best_is_high=True`` scores the most recent / most frequent / highest
    spending customers 5 (documented intent); ``False`` reproduces the coded
    ordering where they score 1. CustomerID breaks ties. Scores follow from the
    rows at which the buckets start (see ``selection``): the customers are
    neither sorted nor shuffled again.
    """
    # read by the selection of the cut rows and by the scoring: written once
    metrics = cut_lineage(customer_metrics(silver, p.anchor, activity))
    hi = p.best_is_high
    # (score, value, ascending): best_is_high puts the most recent / most
    # frequent / highest spending customers in the last bucket.
    specs = [("r_score", "recency_days", not hi), ("f_score", "frequency", hi), ("m_score", "monetary", hi)]
    # ascending values, those without a value first in either direction
    value = {name: F.coalesce(F.col(c).cast("double") if asc else -F.col(c).cast("double"), F.lit(float("-inf"))) for name, c, asc in specs}

    def ranks(name: str, n: int) -> list[int]:
        at = selection.around(n, p.whale_percentile) if n and name == "m_score" else []
        return [*selection.ntile_starts(n, p.buckets), *(at if hi else [n - 1 - r for r in at])]

    found = selection.at_ranks(metrics, value, ranks, "CustomerID", max_band)
    scored = metrics
    for name, _, _ in specs:
        n, rows = found[name]
        scored = scored.withColumn(name, selection.bucket(value[name], "CustomerID", [rows[r] for r in selection.ntile_starts(n, p.buckets) if r < n]))
    n, rows = found["m_score"]
    ascending = rows if hi else {n - 1 - r: (-v, k) for r, (v, k) in rows.items()}
    scored = scored.withColumn("_whale_min", F.lit(selection.interpolated(ascending, n, p.whale_percentile)).cast("double"))

    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = rules.segment(r, f, m)
    out = scored.select(
        "CustomerID", "recency_days", "frequency", "monetary", "total_line_items",
        "avg_line_value", "last_purchase_date", "first_purchase_date", "customer_lifespan_days",
        r.cast("long").alias("r_score"), f.cast("long").alias("f_score"), m.cast("long").alias("m_score"),
        (r + f + m).cast("long").alias("rfm_score"),
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_segment_code"),
        seg.alias("customer_segment"),
        F.coalesce(F.col("monetary") >= F.col("_whale_min"), F.lit(False)).alias("is_whale"),
    )
    return out.withColumn("business_priority", rules.priority(F.col("customer_segment")))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and revenue per segment with their shares of the total
    (2-decimal percentages, exact half-up). The grouped frame has one row per
    segment, so the share window runs on a handful of rows."""
    from pyspark.sql import Window

    from ..functions.exprs import cents, half_up_div

    g = segments.groupBy("customer_segment", "business_priority").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("monetary").cast("decimal(22,2)")).alias("_rev"))
    everyone = Window.partitionBy()
    return g.select(
        "customer_segment", "business_priority",
        F.col("customers").cast("long").alias("customers"),
        F.col("_rev").cast("double").alias("revenue"),
        half_up_div(F.col("customers") * 10000, F.sum("customers").over(everyone)).alias("customer_pct"),
        half_up_div(cents("_rev") * 10000, cents(F.sum("_rev").over(everyone))).alias("revenue_pct"),
    )
