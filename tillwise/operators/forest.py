"""Tree ensembles as a table: one row per node, scored by a bounded walk.

Columns: tree, node (0 is the root, numbers without gaps inside a tree),
feature (position in the feature list), threshold, left, right, leaf. An inner
node sends a row left where its feature is at most the threshold, else right
(NULL and NaN go right); a leaf has the probability of class 1 in ``leaf`` and
NULL elsewhere. In this form a fitted forest is stored, compared and scored
like any other table, also by engines that don't know the model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, forget_at_exit, new_folder

SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, leaf double"


def nodes_of(model) -> DataFrame:
    """The nodes of a fitted Spark ML forest classifier of two classes on
    continuous features, read from the form in which Spark stores it."""
    spark = SparkSession.active()
    path = new_folder(spark, "forest")
    model.write().overwrite().save(path)
    forget_at_exit(spark, path)
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    kinds = n["split"]["numCategories"]
    checked = F.when(inner & (kinds >= 0), F.raise_error(F.lit("a split on categories has no threshold")).cast("double")
                     ).when(inner, n["split"]["leftCategoriesOrThreshold"][0])
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        checked.alias("threshold"), F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.when(~inner, n["impurityStats"][1] / total).alias("leaf"))


def _walk(nodes: Column, x: Column, depth: int) -> Column:
    """``leaf`` of the node that a row with features ``x`` reaches."""
    def step(at: Column, _: Column) -> Column:
        n = F.get(nodes, at)
        goes_left = F.get(x, n["feature"]) <= n["threshold"]
        return F.when(n["leaf"].isNotNull(), at).when(goes_left, n["left"]).otherwise(n["right"])

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step))["leaf"]


def score(df: DataFrame, forest: DataFrame, features: Sequence[str], depth: int, out: str = "score",
          digits: int = 9, max_nodes: int = 4_000_000) -> DataFrame:
    """``df`` with the mean of its trees' leaves. ``depth``: splits on the
    longest path; a forest that is deeper gives NULL.

    The forest reaches every task as one array. Its size is that of the model
    (at most trees * 2^(depth + 1) nodes), not of the data, and is counted first:
    more than ``max_nodes`` (some 160 MB) is an error. A forest without trees
    gives NULL."""
    stored = cut_lineage(forest.select(*[c.split()[0] for c in SCHEMA.split(", ")]))
    n, broken = stored.agg(F.count(F.lit(1)), F.count_if(F.col("leaf").isNull() & F.col("threshold").isNull())).first()
    if n > max_nodes:
        raise ValueError(f"the forest has {n} nodes, more than max_nodes={max_nodes}")
    if broken:
        raise ValueError(f"{broken} nodes have neither a threshold nor a leaf")
    trees = (stored.groupBy("tree").agg(F.array_sort(F.collect_list(
                 F.struct("node", "feature", "threshold", "left", "right", "leaf"))).alias("nodes"))
             .agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))))).scalar()
    used = f"__{out}_trees"
    while used in df.columns:
        used += "_"
    x = F.array(*[F.col(f).cast("double") for f in features])
    leaves = F.transform(F.col(used), lambda t: _walk(t["nodes"], x, depth))
    mean = F.aggregate(leaves, F.lit(0.0), lambda a, v: a + v) / F.when(F.size(used) > 0, F.size(used))
    return df.withColumn(used, trees).withColumn(out, F.round(mean, digits)).drop(used)
