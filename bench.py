"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Every query is executed in full
through the ``noop`` sink (all partitions computed, nothing collected). The
plain single-task form of the RFM mart (global windows + ``percentile``) is
timed next to the distributed form for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillwise.functions import rules  # noqa: E402
from tillwise.operators import rfm  # noqa: E402
from tillwise.params import SegmentParams  # noqa: E402
from tillwise.plans.registry import Inputs, headline, queries  # noqa: E402
from tillwise.session import build_session, scratch  # noqa: E402

EXTRA = ["dq_report", "scorecard", "segment_summary", "clv_deciles", "auc_rank", "histograms", "at_risk_exposure_baseline"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def rfm_segments_window(silver: DataFrame, p: SegmentParams = SegmentParams()) -> DataFrame:
    """Plain form with global windows and ``percentile`` (single-task NTILE);
    the comparison baseline for the distributed form."""
    metrics = rfm.customer_metrics(silver, p.anchor)
    hi = p.best_is_high
    tie = F.col("CustomerID").asc()
    r = F.ntile(p.buckets).over(Window.orderBy(rfm._direction("recency_days", not hi), tie))
    f = F.ntile(p.buckets).over(Window.orderBy(rfm._direction("frequency", hi), tie))
    m = F.ntile(p.buckets).over(Window.orderBy(rfm._direction("monetary", hi), tie))
    scored = metrics.select("*", r.alias("r_score"), f.alias("f_score"), m.alias("m_score"))
    scored = scored.withColumn("_whale_min", metrics.agg(F.percentile("monetary", p.whale_percentile)).scalar())
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    out = scored.select(
        "CustomerID", "recency_days", "frequency", "monetary", "total_line_items",
        "avg_line_value", "last_purchase_date", "first_purchase_date", "customer_lifespan_days",
        r.cast("long").alias("r_score"), f.cast("long").alias("f_score"), m.cast("long").alias("m_score"),
        (r + f + m).cast("long").alias("rfm_score"),
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_segment_code"),
        rules.segment(r, f, m).alias("customer_segment"),
        F.coalesce(F.col("monetary") >= F.col("_whale_min"), F.lit(False)).alias("is_whale"),
    )
    return out.withColumn("business_priority", rules.priority(F.col("customer_segment")))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="tillwise-bench-")
    spark = build_session(
        f"local[{cpus}]", app="tillwise-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.checkpoint.dir": os.path.join(work, "ckpt"),
               "spark.local.dir": os.path.join(work, "local")})
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    names = headline() + [n for n in EXTRA if n in q]
    # warm-up: JVM class loading and parquet footers, not counted
    run(q["observation_end"](spark, sf_dir))
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        with scratch(spark):  # intermediate tables go with the query
            run(q[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run(rfm_segments_window(Inputs(spark, sf_dir).silver))
    times["rfm_segments_plain_window"] = round(time.perf_counter() - t0, 3)
    total = round(sum(v for k, v in times.items() if k in names), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
