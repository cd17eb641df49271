"""Rows at given ranks against sorting, with bands small enough to narrow."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwise.operators import evaluation as E
from tillwise.operators import selection


def values(kind, n, rng):
    draw = {"spread": lambda: rng.random() * 1e6, "ties": lambda: float(rng.choice([1, 1, 1, 1, 2, 3])), "skewed": lambda: round(rng.paretovariate(0.7), 2),
            "one": lambda: 5.0, "missing": lambda: rng.choice([None, rng.random()])}[kind]
    return [draw() for _ in range(n)]


@pytest.mark.parametrize("max_band", [7, 200_000])
def test_rows_at_ranks(spark, max_band):
    rng = random.Random(max_band)
    kinds = ["spread", "ties", "skewed", "one", "missing"]
    cols = [values(k, 900, rng) for k in kinds]
    rows = [(f"k{i:04d}", *v) for i, v in enumerate(zip(*cols))]
    df = spark.createDataFrame(rows, "key string, " + ", ".join(f"{k} double" for k in kinds)).repartition(4).cache()
    wanted = {k: sorted(rng.sample(range(400), 6) + [0]) for k in kinds}
    for key in ("key", None):
        got = selection.at_ranks(df, {k: F.col(k) for k in kinds}, lambda name, n: [*wanted[name], n - 1, n + 5], key, max_band)
        for j, k in enumerate(kinds):
            order = sorted((r[j + 1], r[0]) for r in rows if r[j + 1] is not None)
            n, found = got[k]
            assert n == len(order) and sorted(found) == sorted({*wanted[k], n - 1})
            for r, (v, x) in found.items():
                assert (v, x) == (order[r] if key else (order[r][0], None))
    med = selection.quantiles(df, kinds, 0.5, max_band)
    for j, k in enumerate(kinds):
        assert med[k] == pytest.approx(np.median([v for v in cols[j] if v is not None]), abs=1e-12)


def test_empty_and_tiny(spark):
    df = spark.createDataFrame([], "key string, x double")
    assert selection.at_ranks(df, {"x": F.col("x")}, lambda _, n: [0, 1], "key") == {"x": (0, {})}
    assert selection.quantiles(df, ["x"]) == {"x": None}
    two = spark.createDataFrame([("a", 1.0), ("b", 4.0)], "key string, x double")
    assert selection.quantiles(two, ["x"], 0.25) == {"x": 1.75}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 128])
def test_buckets_equal_ntile(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame([(f"k{i}", float(rng.randrange(4))) for i in range(n)], "key string, v double").cache()
    size, found = selection.at_ranks(df, {"v": F.col("v")}, lambda _, m: selection.ntile_starts(m, 5), "key", 9)["v"]
    starts = [found[r] for r in selection.ntile_starts(size, 5) if r < size]
    got = df.select("key", selection.bucket(F.col("v"), "key", starts).alias("b"))
    want = df.select("key", F.ntile(5).over(Window.orderBy("v", "key")).alias("b"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_reduced_roc_drops_collinear_points(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < s), round(s, 2)) for s in (rng.random() for _ in range(700))]
    df = spark.createDataFrame(rows, "label int, score double").repartition(4)
    order = sorted({s for _, s in rows}, reverse=True)
    tps = np.cumsum([sum(y for y, v in rows if v == s) for s in order])
    fps = np.cumsum([sum(1 - y for y, v in rows if v == s) for s in order])
    kept = np.concatenate([[True], (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), [True]])
    want = {(s, round(f / fps[-1], 9), round(t / tps[-1], 9)) for s, f, t, k in zip(order, fps, tps, kept) if k} | {(float("inf"), 0.0, 0.0)}
    got = {(r.threshold, r.fpr, r.tpr) for r in E.reduced_roc(df).collect()}
    assert got == want and len(got) < len(order) + 1
    straight = spark.createDataFrame([(i % 2, float(i // 2)) for i in range(40)], "label int, score double").repartition(5)
    assert E.reduced_roc(straight).count() == 3          # both ends and the origin
