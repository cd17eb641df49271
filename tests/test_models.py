"""Trained-model queries: shapes, ranges and reruns (no SQL twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL
from tillwise.plans.registry import queries


def test_churn_models_score_and_compare(spark):
    q = queries()
    cmp = q["model_comparison"](spark, SMALL).collect()
    assert {r.model for r in cmp} == {"Logistic Regression", "Random Forest"}
    for r in cmp:
        assert 0.0 <= r.auc <= 1.0 and 0.0 <= r.accuracy <= 1.0
    scores = q["lr_scores"](spark, SMALL)
    assert scores.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_risk_tiers_cover_every_customer(spark):
    q = queries()
    tiers = q["risk_tiers"](spark, SMALL)
    n = tiers.count()
    summary = q["risk_summary"](spark, SMALL).collect()
    assert sum(r.customers for r in summary) == n
    again = q["risk_tiers"](spark, SMALL).select("CustomerID", "churn_risk_score")
    assert tiers.select("CustomerID", "churn_risk_score").exceptAll(again).count() == 0


def test_kmeans_segments(spark):
    q = queries()
    seg = q["kmeans_segments"](spark, SMALL)
    assert seg.where(F.col("cluster").isNull()).count() == 0
    assert seg.select("cluster").distinct().count() == 4
    mapping = q["cluster_mapping"](spark, SMALL).collect()
    assert len(mapping) == 4


def test_logistic_folds_share_their_jobs_and_agree_with_spark_ml(spark, monkeypatch):
    import numpy as np

    from tillwise.operators import evaluation as E, modeling as M, newton
    from tillwise.plans import catalog_model
    from tillwise.plans.registry import Inputs

    prep = catalog_model._prepared(Inputs(spark, SMALL, share_bronze=True))
    train = prep.where("is_train")
    ml = M.fit(train.where("fold <> 0"), "lr")
    held = M.score(ml, train.where("fold = 0")).select(F.col(M.LABEL).alias("label"), "score")
    steps, sums = [], newton._sums
    monkeypatch.setattr(newton, "_sums", lambda *a: steps.append(1) or sums(*a))
    monkeypatch.delattr(M, "fit")                       # no fold is fitted by itself
    got = {r.fold: r.auc for r in M.cv_auc(prep, "lr").collect()}
    assert set(got) == {"0", "1", "2", "3", "4", "mean", "plus_minus"} and len(steps) <= 20
    assert abs(got["0"] - E.auc_rank(held).first()["auc"]) < 0.002
    assert np.allclose(M.newton_fit(prep, folds=True)[0][1:], ml.model.coefficients.toArray(), atol=1e-3)


def test_forest_with_remembered_nodes_is_the_same_forest(spark):
    from tillwise.operators import modeling as M
    from tillwise.params import ModelParams
    from tillwise.plans import catalog_model
    from tillwise.plans.registry import Inputs

    train = catalog_model._prepared(Inputs(spark, SMALL, share_bronze=True)).where("is_train")
    p = ModelParams(rf_trees=8)
    got = M.fit(train, "rf", p).model
    assert got.getCacheNodeIds()
    plain = M.forest_estimator(p).setCacheNodeIds(False).fit(M._assembled(train, False))
    assert got.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
