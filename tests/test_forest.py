"""Forests as tables: the walk against Spark ML's own transform, edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tillwise.operators import forest, modeling as M
from tillwise.params import ModelParams
from tillwise.plans import catalog_model
from tillwise.plans.registry import Inputs


def test_walk_agrees_with_transform(spark):
    p = ModelParams(rf_trees=12, rf_depth=5, rf_min_leaf=3)
    prep = catalog_model._prepared(Inputs(spark, SMALL, share_bronze=True))
    fitted = M.fit(prep.where("is_train"), "rf", p)
    nodes = forest.nodes_of(fitted.model)
    assert nodes.select("tree").distinct().count() == 12 and nodes.where("leaf IS NULL").count() > 12
    want = {r.CustomerID: r.score for r in M.score(fitted, prep).collect()}
    got = forest.score(prep, nodes, M.FEATURES, p.rf_depth).select("CustomerID", "score").collect()
    assert len(got) == len(want)
    assert all(r.score == pytest.approx(want[r.CustomerID], abs=1e-9) for r in got)


NODES = [(0, 0, 0, 1.0, 1, 2, None), (0, 1, None, None, None, None, 0.25), (0, 2, 1, 5.0, 3, 4, None),
         (0, 3, None, None, None, None, 0.5), (0, 4, None, None, None, None, 1.0),
         (7, 0, None, None, None, None, 0.75)]


def test_null_nan_and_equal_values(spark):
    rows = [(1, 1.0, 0.0), (2, 1.5, 5.0), (3, None, 6.0), (4, math.nan, None), (1, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "k int, a double, __score_trees double")   # a clashing name stays
    table = spark.createDataFrame(NODES, forest.SCHEMA).orderBy(F.desc("node"))
    out = forest.score(df, table, ["a", "__score_trees"], depth=2)
    assert out.columns == ["k", "a", "__score_trees", "score"]
    assert sorted((r.k, r.score) for r in out.collect()) == [(1, 0.5), (1, 0.5), (2, 0.625), (3, 0.875), (4, 0.875)]
    shallow = forest.score(df, table, ["a", "__score_trees"], depth=1).collect()
    assert [r.score for r in shallow if r.k == 3] == [None]


def test_no_trees_no_rows_and_bounds(spark):
    table = spark.createDataFrame(NODES, forest.SCHEMA)
    df = spark.createDataFrame([(1, 1.0)], "k int, a double")
    assert forest.score(df, table.limit(0), ["a"], 2).first().score is None
    assert forest.score(df.limit(0), table, ["a", "a"], 2).collect() == []
    with pytest.raises(ValueError, match="max_nodes"):
        forest.score(df, table, ["a"], 2, max_nodes=5)
    with pytest.raises(ValueError, match="neither"):
        forest.score(df, table.withColumn("threshold", F.lit(None).cast("double")), ["a"], 2)
