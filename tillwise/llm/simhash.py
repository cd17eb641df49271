"""SimHash near-dedup by segment-popcount embedding (operator 8).

A fingerprint is cut into 32 segments of two bits and mapped to the vector of
their bit counts (0, 1 or 2). A bit flip changes one count by one, so the
Manhattan distance of two vectors is never above the Hamming distance of the
fingerprints. Counts are kept in unary (00, 01, 11), which puts the vector in
one 64-bit number and makes the Manhattan distance the popcount of an XOR.

Points within Manhattan distance r differ in at most r of the G coordinate
groups, so they agree on all counts of some G - r groups: the range join
becomes equi-joins on the grid cells of every choice of G - r groups. G grows
with the number of fingerprints, so that cells stay small at every size; the
result is the same for each G. Within a cell candidates pass the Manhattan
bound first, then the exact Hamming distance.

Exact copies share a fingerprint and are joined before anything else, and a
cell hands on a spanning forest of its links, not its pairs. A cell with many
rows is searched from one point at a time: what lies within the distance
leaves the cell, so a dense group of near copies costs one pass per member
over the rest only. Cells above ``max_cell`` rows are cut into blocks, and
every pair of blocks is a cell of its own.

Edge cases: texts without a word (NULL, empty) have fingerprint zero and are
linked like any other; shorter texts than a shingle are one shingle. Rows that
repeat a doc_id are rows of that document. A NULL doc_id takes part, but names
a component only if no member has an id (then component_id is NULL).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import cut_lineage
from . import graph

SEED = 42
SEGMENTS = 32
CELL_BITS = 1.415  # bits of a segment's count: -log2(1/16 + 1/4 + 1/16)


@dataclass(frozen=True)
class Params:
    shingle: int = 4
    max_distance: int = 4
    per_cell: int = 16          # fingerprints aimed at in a cell
    max_cell: int = 100_000     # rows of a cell before it is cut into blocks
    small_cell: int = 48        # up to here cells are compared lag by lag, all at once


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text (UTF-8)."""
    import xxhash

    words = text.lower().split()   # bytes: A-Z only; space and 0x09 to 0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    k = min(shingle, len(words))
    ends = np.cumsum(size + 1) - 1
    begin, end = (ends - size)[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(begin), 1 << 15):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[i:i + (1 << 15)], end[i:i + (1 << 15)])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint as a signed long) per row."""

    def run(batches):
        for b in batches:
            col = b.column(1).cast(pa.binary())
            fp = np.array([fingerprint(t.as_py() or b"", params.shingle) for t in col], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    src = docs.select(id_col, F.col(text_col).alias("_text"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, fp long")


def unary_counts(fp: str) -> F.Column:
    """Bit counts of the 2-bit segments, in unary."""
    low = F.col(fp).bitwiseAND(F.lit(0x5555555555555555))
    high = F.shiftrightunsigned(F.col(fp), 1).bitwiseAND(F.lit(0x5555555555555555))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grid_masks(n: int, params: Params) -> list[int]:
    """Signed 64-bit masks: the grid coordinates of each choice of groups."""
    r = params.max_distance
    groups = next((g for g in range(r + 2, 2 * r + 1) if n / 2 ** (CELL_BITS * SEGMENTS * (g - r) / g) <= params.per_cell), 2 * r + 1)
    cut = [SEGMENTS * i // groups for i in range(groups + 1)]
    part = [sum(3 << 2 * s for s in range(cut[i], cut[i + 1])) for i in range(groups)]
    masks = [sum(part[i] for i in c) for c in combinations(range(groups), groups - r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
        # the roots themselves take part in the next round
        a, b = np.concatenate([a, root[a]]), np.concatenate([b, root[b]])
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def _near(u: np.ndarray, f: np.ndarray, u0, f0, r: int) -> np.ndarray:
    """Manhattan bound first, exact distance for what passes."""
    ok = np.bitwise_count(u ^ u0) <= r
    at = np.flatnonzero(ok)
    ok[at] = np.bitwise_count(f[at] ^ (f0[at] if isinstance(f0, np.ndarray) else f0)) <= r
    return ok


def _crowded(u: np.ndarray, f: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of one cell's links as (member, first member)."""
    rest = np.arange(len(f))
    member, first = [], []
    while len(rest):
        start, rest = rest[0], rest[1:]
        todo = [start]
        while todo and len(rest):
            x = todo.pop()
            hit = _near(u[rest], f[rest], u[x], f[x], r)
            found = rest[hit]
            rest = rest[~hit]
            todo.extend(found.tolist())
            member.append(found)
            first.append(np.full(len(found), start))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(member), cat(first)


def _cells(cell: np.ndarray, u: np.ndarray, f: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by cell number, as (fp, fp)."""
    cut = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[cut, len(cell)])
    out_a, out_b = [], []
    for s, n in zip(cut[size > p.small_cell].tolist(), size[size > p.small_cell].tolist()):
        a, b = _crowded(u[s:s + n], f[s:s + n], p.max_distance)
        out_a.append(a + s)
        out_b.append(b + s)
    small = np.repeat((size > 1) & (size <= p.small_cell), size)
    at = np.flatnonzero(small)
    a, b = [], []
    for lag in range(1, p.small_cell):
        at = at[at + lag < len(cell)]
        at = at[cell[at] == cell[at + lag]]
        if not len(at):
            break
        hit = _near(u[at], f[at], u[at + lag], f[at + lag], p.max_distance)
        a.append(at[hit])
        b.append(at[hit] + lag)
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        seen, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = _roots(len(seen), where[:len(a)], where[len(a):])
        moved = root != np.arange(len(seen))
        out_a.append(seen[moved])
        out_b.append(seen[root[moved]])
    if not out_a:
        return f[:0], f[:0]
    return f[np.concatenate(out_a)], f[np.concatenate(out_b)]


def links(distinct: DataFrame, params: Params = Params()) -> DataFrame:
    """``distinct``: one row per fingerprint (fp). Returns links (a, b) that
    connect exactly the fingerprints that the distance connects."""
    n = distinct.count()
    masks = grid_masks(n, params)
    grid = (distinct.select("fp", unary_counts("fp").alias("u"))
                    .select("fp", "u", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("t", "mask"))
                    .select("fp", "u", "t", F.col("u").bitwiseAND(F.col("mask")).alias("key"), F.lit(0).alias("block")))
    if n > params.max_cell:  # a cell can't hold more than there are fingerprints
        crowded = cut_lineage(grid.groupBy("t", "key").count().filter(F.col("count") > params.max_cell))
        if not crowded.isEmpty():
            half = F.lit(params.max_cell // 2)
            k = F.coalesce(F.ceil(F.col("count") / half), F.lit(1)).cast("int")
            mine = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
            grid = (grid.drop("block").join(crowded, ["t", "key"], "left").withColumn("k", k).withColumn("i", mine)
                        .withColumn("j", F.explode(F.expr("sequence(0, k - 1)")))
                        .select("fp", "u", "t", "key", (F.least("i", "j") * F.col("k") + F.greatest("i", "j")).cast("int").alias("block")))

    def run(batches):
        names = ["t", "key", "block", "u", "fp"]
        held, rows = [], 0
        cols: list[np.ndarray] = []

        def flush(cols):
            change = np.zeros(len(cols[0]), dtype=bool)
            for c in cols[:3]:
                change[1:] |= c[1:] != c[:-1]
            a, b = _cells(np.cumsum(change), cols[3].view(np.uint64), cols[4].view(np.uint64), params)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append([np.asarray(batch.column(n), dtype=np.int64) for n in names])
            rows += len(batch)
            if rows < 100_000:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            same = np.ones(rows, dtype=bool)
            for c in cols[:3]:
                same &= c == c[-1]
            whole = rows - int(same[::-1].argmin()) if not same.all() else 0  # the last cell may go on in the next batch
            if whole:
                yield flush([c[:whole] for c in cols])
            held, rows = [[c[whole:].copy() for c in cols]], rows - whole
        if rows:
            yield flush([np.concatenate(x) for x in zip(*held)])

    return grid.repartition("t", "key", "block").sortWithinPartitions("t", "key", "block").mapInArrow(run, "a long, b long")


def tagged(docs: DataFrame, name: str, params: Params = Params(), text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint as one more column."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py() or b"", params.shingle) for t in b.column(at).cast(pa.binary())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def classes(fps: DataFrame, params: Params = Params(), id_col: str = "doc_id") -> DataFrame:
    """``fps``: id and fp per row. Per fingerprint the smallest one reachable
    (root) and the smallest id of any document reachable (component_id)."""
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min(id_col).alias("low")))
    comp = graph.components(links(distinct, params))
    named = distinct.join(comp, distinct.fp == comp.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    linked = named.join(comp.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("low").alias("component_id"))
    return named.join(linked, "root", "left").select("fp", "root", F.coalesce("component_id", "low").alias("component_id"))


def near_duplicates(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` (smallest id reachable) per row."""
    fps = cut_lineage(fingerprints(docs, params, id_col, text_col))
    return fps.join(classes(fps, params, id_col), "fp").select(id_col, "fp", "component_id")


def hex_fingerprint(fp: str) -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
