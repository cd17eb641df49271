"""Hand-made edge rows per operator (FIXTURES.md section 3) and invariants."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwise.functions import rules
from tillwise.functions.exprs import days_between, half_up_div
from tillwise.operators import clustering as C
from tillwise.operators import evaluation as E
from tillwise.operators import quality, ranking
from tillwise.operators.churn import churn_features
from tillwise.operators.clv import clv_inputs, purchase_history
from tillwise.operators.rfm import rfm_segments
from tillwise.operators.silver import stg_customers, stg_transactions
from tillwise.params import SegmentParams
from tillwise.sources.bronze import INVOICE_DDL

ROW = ("536365", "85123A", "WHITE HANGING HEART", 6, "01-12-2010 08:26", 2.55, "17850", "United Kingdom")


def bronze(spark, rows):
    return spark.createDataFrame(rows, INVOICE_DDL)


def test_silver_cleaning_rules(spark):
    rows = [
        ROW, ROW, ROW[:2] + ("OTHER TEXT",) + ROW[3:],            # duplicate -> 2 remain
        (None,) + ROW[1:],                                          # NULL InvoiceNo dropped
        ROW[:4] + ("1-12-2010 8:26",) + ROW[5:],                    # single-digit date: NULL
        ROW[:4] + ("2010-12-01",) + ROW[5:],
        ROW[:4] + (None,) + ROW[5:],
        ("p1",) + ROW[1:5] + (0.0,) + ROW[6:],                      # price edges
        ("p2",) + ROW[1:5] + (0.009,) + ROW[6:],
        ("p3",) + ROW[1:5] + (0.01,) + ROW[6:],
        ("C536379",) + ROW[1:],                                     # cancelled
        ("q0",) + ROW[1:3] + (0,) + ROW[4:],
        ("nc",) + ROW[1:6] + (None, "United Kingdom"),              # no customer
        ("x1",) + ROW[1:3] + (10000,) + ROW[4:5] + (5000.0,) + ROW[6:],
        ("x2",) + ROW[1:3] + (10001,) + ROW[4:5] + (5000.01,) + ROW[6:],
        ("nocountry",) + ROW[1:7] + (None,),
    ]
    s = stg_transactions(bronze(spark, rows)).collect()
    by_inv = {}
    for r in s:
        by_inv.setdefault(r.InvoiceNo, []).append(r)
    assert len(by_inv["536365"]) == 2
    assert set(by_inv) == {"536365", "p3", "x1", "x2", "nocountry"}
    assert by_inv["x1"][0].is_extreme_quantity is False and by_inv["x1"][0].is_extreme_price is False
    assert by_inv["x2"][0].is_extreme_quantity is True and by_inv["x2"][0].is_extreme_price is True
    assert by_inv["nocountry"][0].is_uk_customer is False
    assert by_inv["536365"][0].invoice_timestamp == dt.datetime(2010, 12, 1, 8, 26)
    assert float(by_inv["536365"][0].line_total) == 15.30


def test_day_difference_counts_elapsed_days(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 1, 1, 23, 0), dt.datetime(2011, 1, 3, 1, 0))], "a timestamp, b timestamp")
    assert df.select(days_between("a", "b").alias("d")).first().d == 1


@pytest.mark.parametrize("n,expected", [(7, [2, 2, 1, 1, 1]), (3, [1, 1, 1]), (103, None), (1000, None)])
def test_distributed_ntile_equals_window(spark, n, expected):
    rng = random.Random(n)
    df = spark.createDataFrame([(f"c{i:04d}", rng.randint(0, 5)) for i in range(n)], "k string, v int")
    got = ranking.ntile(df, 5, [F.col("v").desc(), F.col("k")], "b", partitions=3)
    want = df.withColumn("b", F.ntile(5).over(Window.orderBy(F.col("v").desc(), F.col("k"))))
    assert sorted(got.collect()) == sorted(want.collect())
    sizes = [r["count"] for r in got.groupBy("b").count().orderBy("b").collect()]
    if expected:
        assert sizes == expected
    assert max(sizes) - min(sizes) <= 1


def test_global_index_spreads_a_hot_value(spark):
    # one value holds half of all rows: the tie-break key still spreads it
    rows = [(f"k{i:05d}", 1 if i % 2 else i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v long")
    tagged = ranking.range_tag(df, [F.col("v"), F.col("k")], partitions=8)
    per_part = [r["count"] for r in tagged.groupBy("_pid").count().collect()]
    assert max(per_part) < 2000
    idx = ranking.global_index(df, [F.col("v"), F.col("k")], partitions=8)
    assert sorted(r._idx for r in idx.collect()) == list(range(4000))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rng = random.Random(7)
    vals = [(g, rng.random() * 100) for g in ("a", "b") for _ in range(rng.randint(5, 60))]
    df = spark.createDataFrame(vals, "g string, x double")
    got = {r.g: (r.q1, r.med, r.q3) for r in
           ranking.exact_quantiles(df, "x", {"q1": 0.25, "med": 0.5, "q3": 0.75}, ["g"]).collect()}
    for g in ("a", "b"):
        xs = [v for gg, v in vals if gg == g]
        assert got[g] == pytest.approx(tuple(np.percentile(xs, [25, 50, 75])), rel=1e-12)


def test_qcut_right_closed_like_pandas(spark):
    import pandas as pd
    df = spark.createDataFrame([(i, float(i)) for i in range(11)], "id int, x double")
    got = {r.id: r.d for r in ranking.qcut(df, "x", 10, "d").collect()}
    want = (pd.qcut(pd.Series([float(i) for i in range(11)]), 10, labels=False) + 1).tolist()
    assert [got[i] for i in range(11)] == want
    assert got[0] == 1 and got[1] == 1


def test_qcut_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(20)], "id int, x double")
    with pytest.raises(ValueError):
        ranking.qcut(df, "x", 10, "d")


@pytest.mark.parametrize("num,den", [(1, 8), (5, 2), (1005, 100), (2, 3), (0, 7), (123456789, 1000)])
def test_half_up_div_exact(spark, num, den):
    got = spark.range(1).select(half_up_div(F.lit(num), F.lit(den)).alias("v")).first().v
    want = float((Decimal(num) / Decimal(100) / Decimal(den)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert got == want


def test_half_up_div_zero_denominator_is_null(spark):
    assert spark.range(1).select(half_up_div(F.lit(5), F.lit(0)).alias("v")).first().v is None


def _segment_py(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 3 and m >= 3:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "New Customers"
    if r >= 3 and f >= 3 and m <= 2:
        return "Potential Loyalists"
    if r <= 2 and f >= 3:
        return "At Risk"
    if r <= 2 and f <= 2 and m >= 3:
        return "Cannot Lose Them"
    if r <= 2 and f <= 2 and m <= 2:
        return "Lost"
    return "Others"


def test_segment_rule_chain_all_125(spark):
    combos = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(combos, "r int, f int, m int")
    out = df.select("r", "f", "m", rules.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert len(out) == 125
    for row in out:
        assert row.s == _segment_py(row.r, row.f, row.m)


def test_tier_edges(spark):
    df = spark.createDataFrame([(v,) for v in [199.99, 200.0, 500.0, 1000.0, 2000.0]], "x double")
    tiers = [r.t for r in df.select(rules.clv_tier(F.col("x")).alias("t")).collect()]
    assert tiers == ["Minimal Value", "Low Value", "Medium Value", "High Value", "VIP (High CLV)"]
    df = spark.createDataFrame([(v,) for v in [0.2, 0.4, 0.6, 0.8, 0.19999]], "x double")
    tiers = [r.t for r in df.select(rules.risk_tier(F.col("x")).alias("t")).collect()]
    assert tiers == ["Low Risk (20-40%)", "Medium Risk (40-60%)", "High Risk (60-80%)",
                     "Critical Risk (80%+)", "Safe (<20%)"]


def _silver_rows(spark, rows):
    return stg_transactions(bronze(spark, rows))


def test_first_purchase_exclusion_window_free_equals_window(spark):
    rows = []
    for i, (inv, ts, price) in enumerate([("1", "01-12-2010 08:00", 3.0), ("1", "01-12-2010 08:00", 1.0),
                                         ("1", "01-12-2010 08:00", 2.0), ("2", "02-12-2010 09:00", 5.0)]):
        rows.append((inv, f"S{i}", "d", 1, ts, price, "A", "United Kingdom"))
    rows.append(("9", "S9", "d", 1, "03-12-2010 10:00", 4.0, "ONE", "United Kingdom"))
    silver = _silver_rows(spark, rows)
    got = {r.CustomerID: (r.frequency, r.monetary_value) for r in purchase_history(silver).collect()}
    w = Window.partitionBy("CustomerID").orderBy("invoice_timestamp", "InvoiceNo", "StockCode", "line_total")
    ref = (silver.withColumn("rn", F.row_number().over(w)).groupBy("CustomerID")
           .agg((F.count("*") - 1).alias("f"), F.round(F.avg(F.when(F.col("rn") > 1, F.col("line_total"))), 2).alias("mv")))
    for r in ref.collect():
        assert got[r.CustomerID][0] == r.f
        assert (got[r.CustomerID][1] is None and r.mv is None) or got[r.CustomerID][1] == float(r.mv)
    ids = [r.CustomerID for r in clv_inputs(silver).collect()]
    assert ids == ["A"]  # the one-line customer is not a repeat buyer


def test_profile_without_lines_gives_nulls_and_false_flags(spark):
    silver = _silver_rows(spark, [ROW, ROW[:4] + ("02-12-2010 08:26",) + ROW[5:]])
    profiles = spark.createDataFrame(
        [("17850", None, None, 1, 1.0, 1, 1, "United Kingdom", 0, 0, "Basic", 9.99, 0),
         ("99999", None, None, 0, 0.0, 0, 0, "France", 200, 300, "Premium", 29.99, 1)],
        "CustomerID string, first_purchase_date timestamp, last_purchase_date timestamp, transaction_count long, "
        "total_spend double, total_items long, unique_products long, country string, recency_days long, "
        "tenure_days long, subscription_tier string, monthly_fee double, churn_label long")
    mart = churn_features(silver, stg_customers(profiles))
    r = {x.CustomerID: x for x in mart.collect()}
    assert r["99999"].total_transactions is None and r["99999"].engagement_score is None
    assert r["99999"].is_whale is False and r["99999"].is_inactive_90d is False
    assert r["17850"].customer_lifespan_days == 1 and r["17850"].purchase_regularity == 30.0
    rep = {(x.column_name, x.test_name): x.failures
           for x in quality.run_checks(mart, "mart_churn_risk", quality.SPECS["mart_churn_risk"]).collect()}
    assert rep[("total_transactions", "not_null")] == 1
    assert rep[("CustomerID", "unique")] == 0


def test_one_day_customer_regularity_imputed_by_median(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 3.0), ("d", 10.0)], "k string, x double")
    out = {r.k: r.x for r in E.impute_median(df, ["x"]).collect()}
    assert out["a"] == 3.0


def test_auc_with_ties_matches_pairwise(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 1]), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = E.auc_rank(df).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert got == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-9)


def test_roc_points_end_at_one(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "label int, score double")
    pts = E.curve_points(df).orderBy(F.col("threshold").desc()).collect()
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0)
    assert (pts[-1].fpr, pts[-1].tpr) == (1.0, 1.0)


def test_mode_tie_takes_smallest(spark):
    rows = [(0, "b", 1, 1, 1.0, 3), (0, "a", 1, 1, 1.0, 3), (0, "b", 1, 1, 1.0, 3), (0, "a", 1, 1, 1.0, 3)]
    df = spark.createDataFrame(rows, "cluster int, customer_segment string, recency_days long, frequency long, "
                                     "monetary double, rfm_score long")
    assert C.cluster_profile(df).first().segment_mode == "a"


def test_stratified_split_sizes(spark):
    rows = [(f"c{i}", 1 if i < 30 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "CustomerID string, churn_label int")
    s = E.stratified_split(df, "churn_label", "CustomerID", 42, 0.8, 5)
    counts = {(r.churn_label, r.is_train): r["count"] for r in s.groupBy("churn_label", "is_train").count().collect()}
    assert counts == {(1, True): 24, (1, False): 6, (0, True): 56, (0, False): 14}
    again = E.stratified_split(df, "churn_label", "CustomerID", 42, 0.8, 5)
    assert sorted(s.collect()) == sorted(again.collect())


@pytest.mark.parametrize("ones, zeros", [(30, 70), (1, 4), (0, 7), (0, 0), (1, 1)])
@pytest.mark.parametrize("fraction", [0.8, 0.999, 0.0])
def test_train_test_cut_equals_the_split(spark, ones, zeros, fraction):
    rows = [(f"c{i}", 1 if i < ones else 0, i) for i in range(ones + zeros)]
    df = spark.createDataFrame(rows, "CustomerID string, churn_label int, x int")
    split = E.stratified_split(df, "churn_label", "CustomerID", 42, fraction, 5).drop("fold")
    cut = E.train_test_cut(df, "churn_label", "CustomerID", 42, fraction)
    assert cut.columns == ["CustomerID", "churn_label", "x", "is_train"]
    assert sorted(cut.collect()) == sorted(split.select(*cut.columns).collect())
    unlabelled = df.withColumn("churn_label", F.lit(None).cast("int"))
    assert E.train_test_cut(unlabelled, "churn_label", "CustomerID").collect() == []


@pytest.mark.parametrize("hi", [True, False])
def test_rfm_distributed_equals_window_form(spark, hi):
    from bench import rfm_segments_window
    from tillwise.plans.registry import Inputs
    silver = Inputs(spark, "/root/testdata/sf0.001").silver
    a = rfm_segments(silver, SegmentParams(best_is_high=hi))
    b = rfm_segments_window(silver, SegmentParams(best_is_high=hi))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_exact_quantiles_with_a_hot_value(spark):
    import numpy as np
    xs = [1.0] * 3000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = ranking.exact_quantiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.99}, partitions=8).first()
    assert (got.a, got.b, got.c) == pytest.approx(tuple(np.percentile(xs, [10, 50, 99])), rel=1e-12)


def test_clv_invoice_unit_counts_invoices(spark):
    from tillwise.params import ClvParams
    rows = [("1", "A1", "d", 1, "01-12-2010 08:00", 2.0, "C1", "United Kingdom"),
            ("1", "A2", "d", 1, "01-12-2010 08:00", 3.0, "C1", "United Kingdom"),
            ("2", "A1", "d", 2, "05-12-2010 09:00", 4.0, "C1", "United Kingdom")]
    silver = _silver_rows(spark, rows)
    by_line = clv_inputs(silver).first()
    by_invoice = clv_inputs(silver, ClvParams(unit="invoice")).first()
    assert (by_line.frequency, by_line.monetary_value) == (2, 5.5)   # lines 3.0 and 8.0 after the first
    assert (by_invoice.frequency, by_invoice.monetary_value) == (1, 8.0)  # second invoice only


def test_recency_anchor_parameter(spark):
    from tillwise.operators.rfm import customer_metrics
    silver = _silver_rows(spark, [ROW])
    at_end = customer_metrics(silver).first().recency_days
    fixed = customer_metrics(silver, "2010-12-11 08:26:00").first().recency_days
    assert (at_end, fixed) == (0, 10)


def test_probability_alive_variants(spark):
    from tillwise.operators.clv import clv_heuristic
    from tillwise.params import ClvParams
    df = spark.createDataFrame([("a", 3, 30, 120, 10.0)], "CustomerID string, frequency long, recency long, T long, monetary_value double")
    coded = clv_heuristic(df).first()
    corrected = clv_heuristic(df, ClvParams(corrected_alive=True)).first()
    assert coded.probability_alive == 0.75 and corrected.probability_alive == 0.25
    assert coded.months_active == 4.0 and coded.freq_per_month == 0.75 and coded.clv_12m == 90.0
