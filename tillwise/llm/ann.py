"""Approximate nearest neighbours by a hierarchical k-means tree (operator 7).

The tree is fitted on a bounded sample: k-means splits the sample into
``branching`` parts, each part again, until a part stands for about
``leaf_rows`` rows of the whole table. Every row of the table is put into a
leaf. A query walks the tree best bin first: a priority queue holds the nodes
seen, nearest centre first; inner nodes push their children, leaves are
visits. How many leaves are visited is calibrated: held-back queries are
searched in the sample exactly, and the visits are widened until the share of
their true neighbours that lie in visited leaves reaches ``recall``; a query
also goes on until its leaves hold enough rows.

Rows and queries meet per shard, a stretch of neighbouring leaves; a query
brings the list of leaves it visits there and takes its k best rows along once
per shard. Leaves larger than a shard, and shards that many queries visit, are
cut into blocks by hash, so no task's work depends on how crowded one leaf is.
Of identical vectors only the ``k`` + 1 smallest ids are searched:
no other copy can be among the k nearest, ties going to smaller ids.

Distances are Euclidean, in double precision, on the original vectors.

Edge cases: NULL and zero vectors, vectors with NULL or non-finite components,
and rows without an id take no part. Vectors of each length are searched on
their own, with a tree of their own. Repeated rows count once; of different
vectors under one id all are candidates and one is the query. With fewer than k candidates all are
returned. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textio


@dataclass(frozen=True)
class Params:
    k: int = 10
    branching: int = 8
    leaf_rows: int = 200
    max_sample: int = 20_000     # bound of the sample that the tree is fitted on
    rounds: int = 8              # of k-means per split
    recall: float = 0.97         # calibrated share of true neighbours in visited leaves
    calibration: int = 200       # held-back queries
    shard_rows: int = 2_000
    block_queries: int = 2_000
    seed: int = 11


@dataclass
class Tree:
    children: list               # per node: its children, or None
    centres: list                # per node: centres of its children
    leaf: list                   # per node: number of its leaf, or -1
    leaves: int
    visits: int = 1


def fit_tree(x: np.ndarray, leaf_size: int, p: Params) -> Tree:
    rng = np.random.default_rng(p.seed)
    tree = Tree([None], [None], [-1], 0)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        part = _split(x[rows], p, rng) if len(rows) > leaf_size else None
        if part is None:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            continue
        of, centres = part
        tree.centres[node] = centres
        tree.children[node] = list(range(len(tree.leaf), len(tree.leaf) + len(centres)))
        for c, child in enumerate(tree.children[node]):
            tree.children.append(None)
            tree.centres.append(None)
            tree.leaf.append(-1)
            todo.append((child, rows[of == c]))
    return tree


def _split(x: np.ndarray, p: Params, rng) -> tuple[np.ndarray, np.ndarray] | None:
    distinct = np.unique(x, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[rng.permutation(len(distinct))[:p.branching]]
    for _ in range(p.rounds):
        of = _nearest(x, centres)
        n = np.bincount(of, minlength=len(centres))
        live = np.flatnonzero(n)
        centres = np.stack([x[of == c].mean(axis=0) for c in live])
    of = _nearest(x, centres)
    live = np.unique(of)
    if len(live) < 2:
        return None
    return np.searchsorted(live, of), centres[live]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if tree.children[node] is None:
            out[rows] = tree.leaf[node]
            continue
        of = _nearest(x[rows], tree.centres[node])
        todo += [(child, rows[of == c]) for c, child in enumerate(tree.children[node]) if (of == c).any()]
    return out


def best_bin_first(tree: Tree, q: np.ndarray):
    """Leaves in the order in which the priority queue gives them out."""
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        if tree.children[node] is None:
            yield tree.leaf[node]
            continue
        d = ((tree.centres[node] - q) ** 2).sum(axis=1)
        for child, x in zip(tree.children[node], d.tolist()):
            heapq.heappush(queue, (x, child))


def nearest(ids: np.ndarray, x: np.ndarray, own, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k rows nearest to ``q`` (ties: smaller id)."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        at = at[d[at] <= np.partition(d[at], k - 1)[k - 1]]
    at = at[np.lexsort((ids[at], d[at]))][:k]
    return ids[at], d[at]


def held_back(x: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(rows to fit on, queries to calibrate with): a fifth at most is held back."""
    order = np.random.default_rng(p.seed + 1).permutation(len(x))
    n = min(p.calibration, len(x) // 5)
    return x[np.sort(order[n:])], x[order[:n]]


def calibrate(tree: Tree, x: np.ndarray, queries: np.ndarray, p: Params) -> int:
    """Leaf visits at which ``recall`` is reached on ``queries``, none of which
    the tree was fitted on."""
    of = leaf_of(tree, x)
    at_visit = []
    for q in queries:
        want, _ = nearest(np.arange(len(x)), x, -1, q, p.k)
        order = {leaf: n for n, leaf in enumerate(best_bin_first(tree, q), 1)}
        at_visit += [order[leaf] for leaf in of[want].tolist()]
    if not at_visit:
        return 1
    return int(np.sort(at_visit)[int(np.ceil(p.recall * len(at_visit))) - 1])


def usable(vec: str) -> Column:
    return F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(vec, lambda v: v != 0), F.lit(False))


def _matrix(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = np.asarray(col.flatten(), dtype=np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def search(rows: DataFrame, queries: DataFrame, params: Params = Params()) -> DataFrame:
    """``rows`` and ``queries``: vec_id, embedding. Per query its nearest rows
    found: query_id, rank, vec_id, score."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("vec"))
    lengths = [r["n"] for r in rows.select(F.size("vec").alias("n")).distinct().orderBy("n").collect()] or [0]
    out = None
    for dim in lengths:                       # no distance exists between vectors of different length
        found = _search(rows, queries, dim, params)
        out = found if out is None else out.unionByName(found)
    return out


def _search(rows: DataFrame, queries: DataFrame, dim: int, params: Params) -> DataFrame:
    """``search`` among the vectors of ``dim`` components."""
    k = params.k
    same = Window.partitionBy("vec").orderBy("vec_id")
    kept = cut_lineage(rows.filter(F.size("vec") == dim).withColumn("_no", F.dense_rank().over(same)).filter(F.col("_no") <= k + 1)
                           .drop("_no").dropDuplicates(["vec", "vec_id"]))
    n = kept.count()
    sample = _matrix(textio.bounded_sample(kept.groupBy("vec_id").agg(F.min("vec").alias("vec")), "vec_id", params.max_sample)
                     .orderBy("vec_id").toArrow().column("vec"))
    sample, held_out = held_back(sample, params)
    tree = fit_tree(sample, max(k, int(params.leaf_rows * len(sample) / max(n, 1))), params)
    tree.visits = calibrate(tree, sample, held_out, params)

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(leaf_of(tree, _matrix(b.column("vec")))), b.column("vec_id"), b.column("vec")],
                                             names=["leaf", "vec_id", "vec"])

    placed = cut_lineage(kept.mapInArrow(place, "leaf long, vec_id long, vec array<double>"))
    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}   # at most one number per leaf of the tree

    # leaves in tree order fill one shard after another; a leaf above the shard size gets shards of its own
    shards: dict[int, list[int]] = {}
    last, room = -1, 0
    for leaf in range(tree.leaves):
        rows_ = held.get(leaf, 0)
        if rows_ > params.shard_rows:
            shards[leaf] = [last + 1 + i for i in range(-(-rows_ // params.shard_rows))]
            last, room = shards[leaf][-1], 0
            continue
        if rows_ > room:
            last, room = last + 1, params.shard_rows
        shards[leaf] = [max(last, 0)]
        room -= rows_

    def route(batches):
        for b in batches:
            vec = _matrix(b.column("vec"))
            row, shard, leaves = [], [], []
            for i in range(len(b)):
                seen, have, mine = 0, 0, {}
                for leaf in best_bin_first(tree, vec[i]):
                    seen += 1
                    have += held.get(leaf, 0)
                    for s in shards[leaf]:
                        mine.setdefault(s, []).append(leaf)
                    if seen >= tree.visits and have >= 4 * (k + 1):
                        break
                row += [i] * len(mine)
                shard += mine
                leaves += mine.values()
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), b.column("vec_id").take(at), b.column("vec").take(at),
                                              pa.array(leaves, pa.list_(pa.int64()))], names=["shard", "query_id", "vec", "leaves"])

    asked = (queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
                    .filter(F.col("vec_id").isNotNull() & usable("vec") & (F.size("vec") == dim)).dropDuplicates(["vec_id"]))
    routed = cut_lineage(asked.mapInArrow(route, "shard long, query_id long, vec array<double>, leaves array<long>"))
    blocks = {r["shard"]: -(-r["count"] // params.block_queries) for r in routed.groupBy("shard").count().collect()}

    def spread(ids) -> np.ndarray:
        return np.asarray(ids).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)

    def deal_rows(batches):
        """A row has one shard and meets all its blocks of queries."""
        for b in batches:
            out, shard, block = [], [], []
            for i, (leaf, h) in enumerate(zip(b.column("leaf").to_pylist(), spread(b.column("vec_id")).tolist())):
                s = shards[leaf][h % len(shards[leaf])]
                for o in range(blocks.get(s, 0)):
                    out.append(i)
                    shard.append(s)
                    block.append(o)
            at = pa.array(out, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(block, pa.int64()), b.column("leaf").take(at),
                                              b.column("vec_id").take(at), b.column("vec").take(at)],
                                             names=["shard", "block", "leaf", "vec_id", "vec"])

    def deal_queries(batches):
        for b in batches:
            block = [h % blocks[s] for s, h in zip(b.column("shard").to_pylist(), spread(b.column("query_id")).tolist())]
            yield pa.RecordBatch.from_arrays([b.column("shard"), pa.array(block, pa.int64()), b.column("query_id"), b.column("vec"),
                                              b.column("leaves")], names=["shard", "block", "query_id", "vec", "leaves"])

    left = placed.mapInArrow(deal_rows, "shard long, block long, leaf long, vec_id long, vec array<double>")
    right = routed.mapInArrow(deal_queries, "shard long, block long, query_id long, vec array<double>, leaves array<long>")

    def meet(rows, queries):
        rows = rows.sort_by("leaf")
        leaf, ids, x = np.asarray(rows.column("leaf")), np.asarray(rows.column("vec_id")), _matrix(rows.column("vec"))
        asked, q = np.asarray(queries.column("query_id")), _matrix(queries.column("vec"))
        out = []
        for i, visits in enumerate(queries.column("leaves").to_pylist() if len(ids) else []):
            lo, hi = np.searchsorted(leaf, visits), np.searchsorted(leaf, visits, side="right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
            out.append(nearest(ids[at], x[at], asked[i], q[i], k))
        size = [len(f[0]) for f in out]
        return pa.table({"query_id": pa.array(np.repeat(asked[:len(out)], size), pa.int64()),
                         "vec_id": pa.array(np.concatenate([f[0] for f in out]) if out else [], pa.int64()),
                         "score": pa.array(np.concatenate([f[1] for f in out]) if out else [], pa.float64())})

    near = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
                .applyInArrow(meet, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
