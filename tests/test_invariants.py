"""Invariants over whole query results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from scans import rows_read
from tillwise.plans.registry import queries


def test_segment_and_tier_counts_sum_to_customers(spark):
    q = queries()
    seg = q["rfm_segments"](spark, SMALL)
    n = seg.count()
    assert sum(r.customers for r in q["segment_summary"](spark, SMALL).collect()) == n
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in seg.groupBy(score).count().collect()]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    clv = q["clv_heuristic"](spark, SMALL)
    tiers = q["clv_tier_summary"](spark, SMALL).collect()
    assert sum(r.customers for r in tiers) == clv.count()
    deciles = q["clv_deciles"](spark, SMALL).collect()
    assert sum(r.customer_count for r in deciles) == clv.count()


def test_data_tests_fail_only_for_profiles_without_lines(spark):
    q = queries()
    report = q["dq_report"](spark, MEDIUM).where(~F.col("passed")).collect()
    lineless = (q["churn_features"](spark, MEDIUM).where(F.col("total_transactions").isNull()).count())
    assert lineless == 3
    assert {(r.table_name, r.column_name, r.test_name) for r in report} == {
        ("mart_churn_risk", c, "not_null") for c in
        ("total_transactions", "total_spend", "recency_days", "engagement_score")}
    assert all(r.failures == lineless for r in report)


def test_profile_check_values(spark):
    q = queries()
    prof = q["customer_profile"](spark, MEDIUM)
    assert prof.count() == 1549
    assert prof.agg(F.sum("churn_label")).first()[0] == 1174
    tiers = {r.subscription_tier: r["count"] for r in prof.groupBy("subscription_tier").count().collect()}
    assert tiers == {"Basic": 646, "Standard": 302, "Premium": 298, "Enterprise": 303}
    clv = q["clv_inputs"](spark, MEDIUM)
    assert clv.count() == 1511 and clv.agg(F.sum("frequency")).first()[0] == 42257


def test_no_pair_producing_joins_in_plans(spark):
    from tillwise.plans.explain import plan_text
    q = queries()
    for name in ["rfm_segments", "churn_features", "clv_enriched", "scorecard", "histograms",
                 "kmeans_assign_fixed", "churn_model_input", "at_risk_exposure_baseline"]:
        text = plan_text(q[name](spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", ["customer_profile", "churn_features", "referential_integrity", "dq_report",
                                  "at_risk_exposure_baseline", "histograms", "describe_metrics", "numeric_summary", "duplicate_example"])
def test_raw_lines_are_read_once(spark, name):
    table = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    with rows_read(spark, "lineitem") as got:
        queries()[name](spark, SMALL).collect()
    assert 0 < got[0] <= table


def test_rows_only_queries_are_the_model_and_sampling_ones():
    from tillwise.plans.registry import oracle_sql
    rows_only = set(queries()) - set(oracle_sql())
    assert rows_only == {"cluster_silhouette", "rf_scores", "cv_auc", "model_comparison", "feature_drivers"}
