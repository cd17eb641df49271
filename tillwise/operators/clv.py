"""Gold mart and scoring: customer lifetime value inputs and heuristic CLV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import cents, clamp, days_between, half_up_div
from ..params import ClvParams
from .ranking import exact_quantiles, global_index, qcut
from .silver import observation_end_value

CLV_INPUT_COLUMNS = [
    "CustomerID", "frequency", "recency", "T", "monetary_value", "first_purchase",
    "last_purchase", "observation_end_date", "purchase_frequency_tier", "value_tier",
]


def purchase_history(silver: DataFrame, unit: str = "line") -> DataFrame:
    """Per customer: first/last timestamp, repeat count and the average value
    of repeat purchases (the first purchase excluded).

    Window-free: the first purchase is ``min_by(value, (ts, tie keys))``, so the
    aggregate combines map-side and never sorts a customer's lines in one
    task. ``unit="invoice"`` counts invoices instead of lines.
    """
    if unit == "invoice":
        lines = (silver.groupBy("CustomerID", "InvoiceNo")
                 .agg(F.min("invoice_timestamp").alias("invoice_timestamp"),
                      F.sum("line_total").alias("line_total"))
                 .withColumn("StockCode", F.lit("")))
    else:
        lines = silver
    order_key = F.struct("invoice_timestamp", "InvoiceNo", "StockCode", "line_total")
    agg = lines.groupBy("CustomerID").agg(
        F.min("invoice_timestamp").alias("first_purchase"),
        F.max("invoice_timestamp").alias("last_purchase"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("line_total").alias("_sum"),
        F.min_by("line_total", order_key).alias("_first_value"),
    )
    repeat_cents = cents("_sum") - cents("_first_value")
    return agg.select(
        "CustomerID", "first_purchase", "last_purchase",
        (F.col("_n") - 1).cast("long").alias("frequency"),
        half_up_div(repeat_cents, F.col("_n") - 1).alias("monetary_value"),
    )


def clv_inputs(silver: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    """Repeat-purchase inputs (frequency, recency, T, monetary value) for
    customers with at least one repeat purchase, plus business tiers."""
    end = observation_end_value(silver)
    h = purchase_history(silver, p.unit)
    out = h.select(
        "CustomerID", "frequency",
        days_between("first_purchase", "last_purchase").cast("long").alias("recency"),
        days_between(F.col("first_purchase"), end).cast("long").alias("T"),
        "monetary_value", "first_purchase", "last_purchase", end.alias("observation_end_date"),
        rules.frequency_tier(F.col("frequency")).alias("purchase_frequency_tier"),
        rules.value_tier(F.col("monetary_value")).alias("value_tier"),
    )
    return out.where(F.col("frequency") > 0)


def clv_preconditions(inputs: DataFrame) -> DataFrame:
    """Counts of rows violating each modelling precondition (one pass)."""
    return inputs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("frequency") == 0).alias("frequency_zero"),
        F.count_if(F.col("recency") < 0).alias("recency_negative"),
        F.count_if(F.col("T") < F.col("recency")).alias("t_below_recency"),
        F.count_if(F.col("monetary_value") <= 0).alias("monetary_not_positive"),
        F.count_if(~((F.col("frequency") > 0) & (F.col("recency") >= 0)
                     & (F.col("T") >= F.col("recency")) & (F.col("monetary_value") > 0)))
        .alias("dropped"),
    ).select(*[F.col(c).cast("long").alias(c) for c in
               ["rows", "frequency_zero", "recency_negative", "t_below_recency",
                "monetary_not_positive", "dropped"]])


def valid_inputs(inputs: DataFrame) -> DataFrame:
    return inputs.where((F.col("frequency") > 0) & (F.col("recency") >= 0)
                        & (F.col("T") >= F.col("recency")) & (F.col("monetary_value") > 0))


def clv_heuristic(inputs: DataFrame, p: ClvParams = ClvParams(),
                  repair_non_finite: bool = False) -> DataFrame:
    """12-month CLV, 6-month purchases, probability alive and CLV tier.

    Validated inputs (monetary value > 0, months active >= 1) cannot yield a
    non-finite CLV, so the median repair is opt-in; ``non_finite_count`` is
    the check."""
    v = valid_inputs(inputs)
    months = F.greatest(F.col("T").cast("double") / F.lit(p.days_per_month), F.lit(p.min_months))
    fpm = F.least(F.col("frequency").cast("double") / F.col("months_active"),
                  F.lit(p.max_freq_per_month))
    one_time = F.col("frequency") == 0
    ratio = F.col("recency").cast("double") / F.greatest(F.col("T"), F.lit(1)).cast("double")
    alive = ratio if p.corrected_alive else F.lit(1.0) - ratio
    out = (v.withColumn("months_active", months)
            .withColumn("freq_per_month", fpm)
            .withColumn("clv_12m", F.when(one_time, F.col("monetary_value")).otherwise(
                F.col("monetary_value") * F.col("freq_per_month") * F.lit(float(p.horizon_months))))
            .withColumn("predicted_purchases_6m", F.when(one_time, F.lit(p.one_time_purchases)).otherwise(
                F.col("freq_per_month") * F.lit(float(p.purchases_horizon_months))))
            .withColumn("predicted_avg_transaction", F.col("monetary_value"))
            .withColumn("probability_alive", clamp(alive, p.alive_floor, p.alive_cap)))
    if repair_non_finite:
        out = repair_with_median(out, "clv_12m")
    return out.withColumn("clv_tier", rules.clv_tier(F.col("clv_12m")))


def _non_finite(c: str):
    x = F.col(c)
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def repair_with_median(df: DataFrame, c: str) -> DataFrame:
    """Replace NaN/inf/NULL by the median of the finite values, only when any
    exist (a one-row count first, as the reference checks before repairing)."""
    bad = df.agg(F.count_if(_non_finite(c)).alias("n")).collect()[0]["n"]
    if not bad:
        return df
    finite = df.where(~_non_finite(c))
    med = exact_quantiles(finite, c, {"_median": 0.5}).select("_median").scalar()
    return df.withColumn(c, F.when(_non_finite(c), med).otherwise(F.col(c)))


def non_finite_count(df: DataFrame, c: str = "clv_12m") -> DataFrame:
    return df.agg(F.count_if(_non_finite(c)).cast("long").alias("bad_values"))


def with_deciles(scored: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    return qcut(scored, "clv_12m", p.deciles, "clv_decile")


def decile_summary(scored: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    d = with_deciles(scored, p)
    return d.groupBy("clv_decile").agg(
        F.round(F.avg("clv_12m"), 2).alias("avg_clv"),
        F.count(F.lit(1)).cast("long").alias("customer_count"))


def tier_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("clv_tier").agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.round(F.sum("clv_12m"), 2).alias("clv_sum"),
        F.round(F.avg("clv_12m"), 2).alias("clv_mean"),
        F.round(F.avg("probability_alive"), 2).alias("probability_alive_mean"),
        F.round(F.avg("predicted_purchases_6m"), 2).alias("predicted_purchases_6m_mean"))


def top_share(scored: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    """Value held by the top ``floor(n * share)`` customers by CLV (ties at the
    cut do not change the sum). One range sort, no single-task window."""
    ranked = global_index(scored.select("CustomerID", "clv_12m"),
                          [F.col("clv_12m").desc(), F.col("CustomerID").asc()])
    top_n = F.floor(F.col("_n").cast("double") * F.lit(p.top_share)).cast("long")
    agg = ranked.agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.sum("clv_12m").alias("total_clv"),
        F.avg("clv_12m").alias("avg_clv"),
        F.max(top_n).alias("top_n"),
        F.sum(F.when(F.col("_idx") < top_n, F.col("clv_12m"))).alias("top_clv"),
    )
    return agg.select(
        "customers", F.round("total_clv", 2).alias("total_clv"), F.round("avg_clv", 2).alias("avg_clv"),
        "top_n", F.round(F.coalesce("top_clv", F.lit(0.0)), 2).alias("top_clv"),
        F.round(F.coalesce("top_clv", F.lit(0.0)) / F.col("total_clv") * 100, 1).alias("top_share_pct"))


def top_customers(scored: DataFrame, n: int = 10) -> DataFrame:
    """Top-n customers by CLV (per-partition top-n, then one small merge)."""
    return (scored.orderBy(F.col("clv_12m").desc(), F.col("CustomerID").asc()).limit(n)
            .select("CustomerID", "frequency", "recency", "monetary_value", "freq_per_month",
                    "predicted_purchases_6m", "clv_12m", "probability_alive"))


def enriched(scored: DataFrame, p: ClvParams = ClvParams()) -> DataFrame:
    """CLV mart with all heuristic columns, decile and tier (the saved table)."""
    return with_deciles(scored, p)
