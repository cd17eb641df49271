"""Connected components of an edge table by alternating large-star and
small-star steps, each a grouped minimum and an equi-join. Every round is
written to the checkpoint folder; the number of rounds grows with the
logarithm of the component size. Nothing but two numbers per round (row count
and a hash of the edge set) reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


MAX_BROADCAST = 400_000  # edges; the minima of more nodes are joined by shuffle


def _stars(e: DataFrame, n: int) -> DataFrame:
    """``n``: number of edges. A hub's edges then stay where they are."""
    near = F.broadcast if n <= MAX_BROADCAST else lambda df: df
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(near(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(near(low), "u").select(F.explode(F.array(
        F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
    return small.select("x.u", "x.v").filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): root is the smallest node of the
    component. Nodes without an edge don't appear; NULLs are left out."""
    e = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    state = mark(e)
    while state[0]:
        nxt = cut_lineage(_stars(e, state[0]))
        after = mark(nxt)
        e = nxt
        if after == state:
            break
        state = after
    # every edge now leads to its component's smallest node
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
