"""Property checks of the distributed order statistics against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwise.operators import evaluation as E
from tillwise.operators import ranking

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=60)


@SETTINGS
@given(values, st.integers(min_value=1, max_value=7))
def test_ntile_matches_window(spark, vs, buckets):
    df = spark.createDataFrame([(f"k{i:03d}", v) for i, v in enumerate(vs)], "k string, v int")
    got = ranking.ntile(df, buckets, [F.col("v"), F.col("k")], "b", partitions=3)
    want = df.withColumn("b", F.ntile(buckets).over(Window.orderBy("v", "k")))
    assert sorted(got.collect()) == sorted(want.collect())


@SETTINGS
@given(values, st.floats(min_value=0.0, max_value=1.0))
def test_quantile_matches_numpy(spark, vs, p):
    df = spark.createDataFrame([(float(v),) for v in vs], "x double")
    got = ranking.exact_quantiles(df, "x", {"q": p}, partitions=3).first().q
    assert got == pytest.approx(float(np.percentile(vs, p * 100)), rel=1e-9, abs=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4)), min_size=2, max_size=50))
def test_rank_auc_matches_pairs(spark, rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "label int, score double")
    pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    assert E.auc_rank(df).first().auc == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-9)
