"""The query catalogue (silver, gold marts, CLV scoring)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import churn, clv, rfm, silver
from ..params import SegmentParams
from . import oracle as O
from .registry import Inputs, register

BRONZE_SILVER = (O.BRONZE, O.SILVER)


@register("bronze_invoice_lines", O.with_ctes(O.BRONZE) + " SELECT * FROM bronze")
def q_bronze(spark, sf_dir):
    return Inputs(spark, sf_dir).bronze


@register("stg_transactions",
          O.with_ctes(*BRONZE_SILVER) + " SELECT * REPLACE (CAST(line_total AS DOUBLE) AS line_total) FROM silver",
          headline=True)
def q_stg_transactions(spark, sf_dir):
    # the table itself is the only consumer here: no materialisation needed
    return silver.output(silver.stg_transactions(Inputs(spark, sf_dir).bronze))


@register("customer_profile", O.with_ctes(*BRONZE_SILVER, O.PROFILES) + " SELECT * FROM profiles")
def q_customer_profile(spark, sf_dir):
    return Inputs(spark, sf_dir, share_bronze=True).profiles


@register("stg_customers", O.with_ctes(*BRONZE_SILVER, O.PROFILES) + " SELECT * FROM stg_customers")
def q_stg_customers(spark, sf_dir):
    return silver.stg_customers(Inputs(spark, sf_dir, share_bronze=True).profiles)


@register("observation_end", O.with_ctes(*BRONZE_SILVER) + " SELECT end_date FROM obs")
def q_observation_end(spark, sf_dir):
    return silver.observation_end(silver.stg_transactions(Inputs(spark, sf_dir).bronze))


@register("customer_metrics", O.with_ctes(*BRONZE_SILVER, O.CUSTOMER_METRICS) + " SELECT * FROM cm")
def q_customer_metrics(spark, sf_dir):
    return rfm.customer_metrics(Inputs(spark, sf_dir).silver)


@register("rfm_segments",
          O.with_ctes(*BRONZE_SILVER, O.CUSTOMER_METRICS, O.segments_cte(True)) + " SELECT * FROM segments",
          headline=True)
def q_rfm_segments(spark, sf_dir):
    return rfm.rfm_segments(Inputs(spark, sf_dir).silver, SegmentParams(best_is_high=True))


@register("rfm_segments_inverted",
          O.with_ctes(*BRONZE_SILVER, O.CUSTOMER_METRICS, O.segments_cte(False)) + " SELECT * FROM segments")
def q_rfm_segments_inverted(spark, sf_dir):
    return rfm.rfm_segments(Inputs(spark, sf_dir).silver, SegmentParams(best_is_high=False))


@register("rfm_segments_as_coded",
          O.with_ctes(*BRONZE_SILVER, O.CUSTOMER_METRICS_TODAY, O.segments_cte(False)) + " SELECT * FROM segments")
def q_rfm_segments_as_coded(spark, sf_dir):
    """The literal original: recency against today's date, bucket 1 = best."""
    return rfm.rfm_segments(Inputs(spark, sf_dir).silver, SegmentParams(best_is_high=False, anchor="current_date"))


@register("segment_summary",
          O.with_ctes(*BRONZE_SILVER, O.CUSTOMER_METRICS, O.segments_cte(True)) + f"""
  SELECT customer_segment, business_priority, CAST(COUNT(*) AS BIGINT) AS customers,
    CAST(SUM(CAST(monetary AS DECIMAL(22,2))) AS DOUBLE) AS revenue,
    {O.half_up('COUNT(*) * 10000', 'SUM(COUNT(*)) OVER ()')} AS customer_pct,
    {O.half_up(O.cents('SUM(CAST(monetary AS DECIMAL(22,2)))') + ' * 10000',
               O.cents('SUM(SUM(CAST(monetary AS DECIMAL(22,2)))) OVER ()'))} AS revenue_pct
  FROM segments GROUP BY customer_segment, business_priority""")
def q_segment_summary(spark, sf_dir):
    seg = rfm.rfm_segments(Inputs(spark, sf_dir).silver, SegmentParams(best_is_high=True))
    return rfm.segment_summary(seg)


# Behaviour counts are NULL for profiles without clean lines (left join).
# The query reports them as DOUBLE on both engines: a NULL-bearing integer
# column otherwise reaches pandas as float64 from Spark but as nullable Int64
# from DuckDB, and the two would not compare equal value by value.
NULLABLE_BEHAVIOUR = ["total_transactions", "total_items", "unique_products", "recency_days",
                      "customer_lifespan_days", "active_months", "has_high_value_order",
                      "has_bulk_purchase"]


def as_double(df, cols):
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def sql_as_double(cols) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"


@register("churn_features",
          O.with_ctes(*BRONZE_SILVER, O.PROFILES, O.CHURN) + f" SELECT {sql_as_double(NULLABLE_BEHAVIOUR)} FROM churn",
          headline=True)
def q_churn_features(spark, sf_dir):
    i = Inputs(spark, sf_dir, share_bronze=True)
    return as_double(churn.churn_features(None, i.customers, activity=i.activity), NULLABLE_BEHAVIOUR)


@register("clv_inputs", O.with_ctes(*BRONZE_SILVER, O.CLV_INPUTS) + " SELECT * FROM clv_inputs",
          headline=True)
def q_clv_inputs(spark, sf_dir):
    return clv.clv_inputs(Inputs(spark, sf_dir).silver)


@register("clv_inputs_invoice",
          O.with_ctes(*BRONZE_SILVER, O.CLV_INPUTS_INVOICE) + " SELECT * FROM clv_inputs_invoice")
def q_clv_inputs_invoice(spark, sf_dir):
    """Repeat purchases counted per invoice instead of per line."""
    from ..params import ClvParams
    return clv.clv_inputs(Inputs(spark, sf_dir).silver, ClvParams(unit="invoice"))


@register("clv_preconditions", O.with_ctes(*BRONZE_SILVER, O.CLV_INPUTS) + """
  SELECT CAST(COUNT(*) AS BIGINT) AS "rows",
    CAST(COUNT(*) FILTER (WHERE frequency = 0) AS BIGINT) AS frequency_zero,
    CAST(COUNT(*) FILTER (WHERE recency < 0) AS BIGINT) AS recency_negative,
    CAST(COUNT(*) FILTER (WHERE T < recency) AS BIGINT) AS t_below_recency,
    CAST(COUNT(*) FILTER (WHERE monetary_value <= 0) AS BIGINT) AS monetary_not_positive,
    CAST(COUNT(*) FILTER (WHERE NOT (frequency > 0 AND recency >= 0 AND T >= recency AND monetary_value > 0)) AS BIGINT) AS dropped
  FROM clv_inputs""")
def q_clv_preconditions(spark, sf_dir):
    return clv.clv_preconditions(clv.clv_inputs(Inputs(spark, sf_dir).silver))


def _scored(spark, sf_dir):
    return clv.clv_heuristic(clv.clv_inputs(Inputs(spark, sf_dir).silver))


CLV_CHAIN = (*BRONZE_SILVER, O.CLV_INPUTS, O.CLV_SCORED)


@register("clv_heuristic", O.with_ctes(*CLV_CHAIN) + " SELECT * EXCLUDE (clv_decile) FROM clv_deciled",
          headline=True)
def q_clv_heuristic(spark, sf_dir):
    return _scored(spark, sf_dir)


@register("clv_enriched", O.with_ctes(*CLV_CHAIN) + " SELECT * FROM clv_deciled")
def q_clv_enriched(spark, sf_dir):
    return clv.enriched(_scored(spark, sf_dir))


@register("clv_deciles", O.with_ctes(*CLV_CHAIN) + """
  SELECT clv_decile, ROUND(AVG(clv_12m), 2) AS avg_clv, CAST(COUNT(*) AS BIGINT) AS customer_count
  FROM clv_deciled GROUP BY clv_decile""")
def q_clv_deciles(spark, sf_dir):
    return clv.decile_summary(_scored(spark, sf_dir))


@register("clv_tier_summary", O.with_ctes(*CLV_CHAIN) + """
  SELECT clv_tier, CAST(COUNT(*) AS BIGINT) AS customers, ROUND(SUM(clv_12m), 2) AS clv_sum,
    ROUND(AVG(clv_12m), 2) AS clv_mean, ROUND(AVG(probability_alive), 2) AS probability_alive_mean,
    ROUND(AVG(predicted_purchases_6m), 2) AS predicted_purchases_6m_mean
  FROM clv_tiered GROUP BY clv_tier""")
def q_clv_tier_summary(spark, sf_dir):
    return clv.tier_summary(_scored(spark, sf_dir))


@register("clv_top_share", O.with_ctes(*CLV_CHAIN) + """,
  ranked AS (SELECT clv_12m, ROW_NUMBER() OVER (ORDER BY clv_12m DESC, CustomerID) - 1 AS idx,
                    COUNT(*) OVER () AS n FROM clv_tiered)
  SELECT CAST(COUNT(*) AS BIGINT) AS customers, ROUND(SUM(clv_12m), 2) AS total_clv,
    ROUND(AVG(clv_12m), 2) AS avg_clv,
    CAST(MAX(CAST(floor(n * 0.1) AS BIGINT)) AS BIGINT) AS top_n,
    ROUND(COALESCE(SUM(CASE WHEN idx < floor(n * 0.1) THEN clv_12m END), 0), 2) AS top_clv,
    ROUND(COALESCE(SUM(CASE WHEN idx < floor(n * 0.1) THEN clv_12m END), 0) / SUM(clv_12m) * 100, 1) AS top_share_pct
  FROM ranked""")
def q_clv_top_share(spark, sf_dir):
    return clv.top_share(_scored(spark, sf_dir))


@register("clv_top10", O.with_ctes(*CLV_CHAIN) + """
  SELECT CustomerID, frequency, recency, monetary_value, freq_per_month, predicted_purchases_6m,
    clv_12m, probability_alive
  FROM clv_tiered ORDER BY clv_12m DESC, CustomerID LIMIT 10""")
def q_clv_top10(spark, sf_dir):
    return clv.top_customers(_scored(spark, sf_dir), 10)


@register("clv_non_finite", O.with_ctes(*CLV_CHAIN) + """
  SELECT CAST(COUNT(*) FILTER (WHERE clv_12m IS NULL OR isnan(clv_12m) OR isinf(clv_12m)) AS BIGINT) AS bad_values
  FROM clv_scored""")
def q_clv_non_finite(spark, sf_dir):
    return clv.non_finite_count(clv.clv_heuristic(clv.clv_inputs(Inputs(spark, sf_dir).silver),
                                                  repair_non_finite=False))


@register("clv_rate_repaired", O.with_ctes(*CLV_CHAIN) + """,
  rate AS (SELECT CustomerID, CASE WHEN recency <> 0 THEN monetary_value / recency END AS v FROM clv_inputs)
  SELECT CustomerID, ROUND(COALESCE(v, (SELECT quantile_cont(v, 0.5) FROM rate WHERE v IS NOT NULL)), 6) AS daily_value FROM rate""")
def q_clv_rate_repaired(spark, sf_dir):
    """Repeat value per day of activity; customers active on a single day have
    an infinite rate, which the median of the finite ones replaces."""
    rate = clv.clv_inputs(Inputs(spark, sf_dir).silver).select("CustomerID", F.when(
        F.col("recency") == 0, F.lit(float("inf"))).otherwise(F.try_divide("monetary_value", "recency")).alias("daily_value"))
    return clv.repair_with_median(rate, "daily_value").withColumn("daily_value", F.round("daily_value", 6))


@register("bronze_csv_ingest", O.with_ctes(O.BRONZE) + " SELECT * FROM bronze")
def q_bronze_csv_ingest(spark, sf_dir):
    """CSV ingest path: the raw lines are landed as ISO-8859-1 CSV in the
    session's checkpoint folder, then read back with the explicit schema."""
    from ..session import forget_at_exit, new_folder
    from ..sources.bronze import read_invoice_csv

    path = new_folder(spark, "landing")
    (Inputs(spark, sf_dir).bronze.write.mode("overwrite").option("header", True)
     .option("encoding", "ISO-8859-1").option("escape", '"').csv(path))
    forget_at_exit(spark, path)
    return read_invoice_csv(spark, path)


LATIN1 = " caf\u00e9 \u00a35 \u00bd \u00ff"


@register("bronze_latin1_ingest", O.with_ctes(O.BRONZE) + f" SELECT * REPLACE (Description || '{LATIN1}' AS Description) FROM bronze")
def q_bronze_latin1_ingest(spark, sf_dir):
    """The CSV path with characters above 0x7F in every description."""
    from ..session import forget_at_exit, new_folder
    from ..sources.bronze import read_invoice_csv

    path = new_folder(spark, "landing")
    lines = Inputs(spark, sf_dir).bronze.withColumn("Description", F.concat("Description", F.lit(LATIN1)))
    lines.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    forget_at_exit(spark, path)
    return read_invoice_csv(spark, path)


_MEDALLION_TABLES = [
    ("online_retail", "bronze", "bronze"), ("stg_transactions", "silver", "silver"),
    ("customers_simulated", "bronze", "profiles"), ("stg_customers", "silver", "stg_customers"),
    ("mart_customer_segments", "gold", "segments"), ("mart_clv_projections", "gold", "clv_inputs"),
    ("mart_churn_risk", "gold", "churn"), ("mart_clv_projections_enriched", "gold", "clv_tiered"),
    ("mart_customer_segments_enriched", "gold", "segments"), ("mart_churn_risk_scored", "gold", "churn"),
]


def _medallion_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, '{schema}' AS schema_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {cte}"
             for t, schema, cte in _MEDALLION_TABLES]
    parts.append("SELECT 'dq_report', 'default', CAST(COUNT(*) AS BIGINT) FROM (" + O.dq_sql() + ")")
    # a cluster per centroid, as long as there are so many different customers
    parts.append("SELECT 'cluster_mapping', 'gold', CAST(LEAST(4, COUNT(*)) AS BIGINT) FROM (SELECT DISTINCT recency_days, frequency, monetary FROM segments)")
    return O.with_ctes(*BRONZE_SILVER, O.PROFILES, O.CUSTOMER_METRICS, O.segments_cte(True), O.CLV_INPUTS,
                       O.CLV_SCORED, O.CHURN) + " " + " UNION ALL ".join(parts)


@register("medallion_row_counts", _medallion_sql())
def q_medallion_row_counts(spark, sf_dir):
    """Full refresh of all eleven tables and the quality report into a new
    folder under the checkpoint folder; each written table is read back and
    counted (writers, schema routing and upstream reads end to end)."""
    from ..session import forget_at_exit, new_folder
    from ..sources.catalog import schema_for, LAYERS
    from .medallion import run

    root = new_folder(spark, "medallion")
    paths = run(spark, sf_dir, root)
    forget_at_exit(spark, root)
    frames = [spark.read.parquet(path).agg(F.count(F.lit(1)).cast("long").alias("row_count"))
              .select(F.lit(name).alias("table_name"), F.lit(schema_for(LAYERS.get(name), "default")).alias("schema_name"),
                      "row_count")
              for name, path in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
