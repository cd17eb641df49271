"""K-Means and logistic regression against plain numpy and Spark ML."""

from __future__ import annotations

import math
import random
from hashlib import md5

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillwise.operators import clustering as C
from tillwise.operators import evaluation as E
from tillwise.operators import lloyd, newton
from tillwise.params import ClusterParams


def points(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.6, (n // 3, 3)) for c in ((0, 0, 0), (3, 0, 1), (-2, 3, 0))])
    return [(f"c{i}", *map(float, v)) for i, v in enumerate(x)]


def plain_kmeans(rows, k, p):
    """Seeding, steps, choice and numbering of ``lloyd`` for one K, in numpy."""
    keys, x = [r[0] for r in rows], np.array([r[1:] for r in rows])
    best = None
    for r in range(p.restarts):
        centres = []
        for t in range(k):
            h = np.array([int(md5(f"{key}|{p.seed + r}|{t}".encode()).hexdigest()[:8], 16) for key in keys])
            d = np.array([min(((v - c) ** 2).sum() for c in centres) for v in x]) if centres else None
            race = h if d is None else np.array([-math.log((a + 0.5) / 2 ** 32) / b if b > 0 else np.inf for a, b in zip(h, d)])
            centres.append(x[min(range(len(x)), key=lambda i: (race[i], keys[i]))])
        c = np.array(centres)
        for _ in range(p.max_iter):
            near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            new = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(k)])
            moved, c = np.abs(new - c).max(), new
            if moved <= 1e-9:
                break
        cost = ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()
        if best is None or round(cost, 9) < round(best[0], 9):
            best = cost, np.array(sorted(map(tuple, c)))
    return best


def test_all_runs_together_equal_each_alone(spark):
    rows, p = points(), ClusterParams(restarts=4)
    df = spark.createDataFrame(rows, "CustomerID string, " + ", ".join(f"{z} double" for z in C.Z)).repartition(5)
    pts = lloyd.uniforms(df, "CustomerID", C.Z)
    found = lloyd.fit(pts, C.Z, [2, 3, 5], p)
    sil = lloyd.silhouettes(pts, C.Z, found)
    x = np.array([r[1:] for r in rows])
    for k, run in found.items():
        cost, centres = plain_kmeans(rows, k, p)
        assert abs(run.cost - cost) < 1e-8 and np.allclose(run.centroids, centres, atol=1e-8)
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        sq = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        value = 0.0
        for i in range(len(x)):
            own = near == near[i]
            a = sq[i][own].sum() / max(own.sum() - 1, 1)
            b = min(sq[i][near == c].mean() for c in range(k) if c != near[i])
            value += (b - a) / max(a, b) if own.sum() > 1 else 0.0
        assert abs(sil[k] - value / len(x)) < 1e-9
    got = {r.CustomerID: r.cluster for r in df.withColumn("cluster", lloyd.nearest(C.Z, found[3])).collect()}
    assert len(set(got.values())) == 3


def test_fewer_rows_than_clusters_and_no_rows(spark):
    schema = "CustomerID string, " + ", ".join(f"{z} double" for z in C.Z)
    few = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("b", 0.0, 0.0, 0.0), ("c", 1.0, 1.0, 1.0)], schema)
    out = {r.CustomerID: r.cluster for r in C.lloyd_assign(few, ClusterParams(restarts=2)).collect()}
    assert out == {"a": 0, "b": 0, "c": 1}
    none = spark.createDataFrame([], schema)
    assert C.lloyd_assign(none, ClusterParams(restarts=2)).count() == 0
    assert C.lloyd_sweep(none, ClusterParams(restarts=2)).count() == 0


def test_exact_silhouette(spark):
    rows = [(f"c{i}", i % 3 if i else 7, *v[1:]) for i, v in enumerate(points(120))]
    df = spark.createDataFrame(rows, "CustomerID string, cluster int, " + ", ".join(f"{z} double" for z in C.Z)).repartition(3)
    for sample in (1000, 50):
        kept = sorted(rows, key=lambda r: md5(f"{r[0]}|42".encode()).hexdigest())[:sample]
        x, c = np.array([r[2:] for r in kept]), np.array([r[1] for r in kept])
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
        want = []
        for i in range(len(x)):
            a = d[i][c == c[i]].sum() / max((c == c[i]).sum() - 1, 1)
            b = min(d[i][c == o].mean() for o in set(c.tolist()) - {c[i]})
            want.append((b - a) / max(a, b) if (c == c[i]).sum() > 1 else 0.0)
        got = C.silhouette_exact(df, sample, block=16).collect()[0]
        assert (got.customers, got.sampled) == (120, len(kept)) and abs(got.silhouette - np.mean(want)) < 1e-6
    one = C.silhouette_exact(df.withColumn("cluster", F.lit(1))).collect()[0]
    assert one.silhouette == 0.0
    assert C.silhouette_exact(df.limit(0)).collect()[0].sampled == 0


def labelled(spark, n=400):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 3))
    y = (x @ [1.5, -0.7, 0.2] + rng.normal(size=n) > 0.4).astype(int)
    rows = [(int(i), *map(float, v), int(t), 0.5 + 1.5 * int(t), i % 4) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, w double, fold int").repartition(5)


def test_newton_agrees_with_spark_ml(spark):
    df = labelled(spark).cache()
    betas = newton.fit(df, ["a", "b", "c"], "y", "w", 1.0, "fold", range(4))
    for m, beta in betas.items():
        rows = df if m == newton.FULL else df.where(F.col("fold") != m)
        total = rows.agg(F.sum("w")).collect()[0][0]
        ml = LogisticRegression(labelCol="y", weightCol="w", regParam=1.0 / total, elasticNetParam=0.0, standardization=False,
                                maxIter=1000, tol=1e-12).fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows))
        assert np.allclose(beta, [ml.intercept, *ml.coefficients], atol=1e-6)


def test_newton_on_separable_and_missing_rows(spark):
    rows = [(float(i), int(i > 50), 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, y int, w double")
    beta = newton.fit(df, ["x"], "y", "w", c=1000.0)[newton.FULL]
    p = 1 / (1 + np.exp(-(beta[0] + beta[1] * np.arange(100))))
    y = (np.arange(100) > 50).astype(float)
    gradient = 1000.0 * np.array([(p - y).sum(), ((p - y) * np.arange(100)).sum()]) + [0.0, beta[1]]
    assert np.abs(gradient).max() < 1e-5            # the optimum of a strictly convex function
    assert newton.fit(df.limit(0), ["x"], "y", "w")[newton.FULL].tolist() == [0.0, 0.0]


def test_auc_by_group(spark):
    rng = random.Random(5)
    rows = [(g, rng.randrange(2), round(rng.random(), 1)) for g in range(3) for _ in range(60)] + [(3, 1, 0.5), (3, 1, 0.6)]
    got = {r.g: r.auc for r in E.auc_by_group(spark.createDataFrame(rows, "g int, label int, score double"), "g").collect()}
    for g in range(3):
        pos = [s for h, y, s in rows if h == g and y]
        neg = [s for h, y, s in rows if h == g and not y]
        want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        assert got[g] == pytest.approx(want)
    assert got[3] is None


def test_closest_is_the_row_minimum_of_squares():
    import numpy as np

    from tillwise.operators import lloyd

    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 3)), 1)              # rounded: many ties
    for k in (1, 2, 7):
        c = np.round(rng.normal(size=(k, 3)), 1)
        d = lloyd.squares(x, c)
        near, best = lloyd.closest(x, c)
        assert (near == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert [len(v) for v in lloyd.closest(x[:0], c)] == [0, 0]
