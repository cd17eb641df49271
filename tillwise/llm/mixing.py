"""Mixing sources to target weights along a time-varying curriculum
(operator 9). DataFrame functions only.

1. Targets. Every source gets its share of all words by weight; a target stops
   at ``max_repeat`` times the source's size, and what is left over is shared
   again by weight among the others until none is above.
2. Taking. A source's documents form a stream in hash order, repeated as often
   as the target asks; a document gives the part of its copies that lies
   before the target, so a source's taken words sum to its rounded target.
   The order is total: hash of the id, size, hash of the row, row number.
   Running sums are taken per (source, range of that order) plus the ranges
   before, so neither a source nor an id that holds a third of all rows meets
   in one group.
3. Positions. A source's weight schedule is a piecewise linear function of
   training time 0..1. Its integral, scaled to the target, is the cumulative
   demand; the middle of each copy is put where that demand is reached, by
   inverting the integral (a quadratic per piece). Documents are range-sorted
   by the position of their first copy.

Edge cases: NULL or empty texts have size 0 and are never taken; a NULL
source is a source of its own, the last; rows may share their doc_id, and a
NULL doc_id is ordered just after an empty id. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_index, range_tag
from ..session import cut_lineage

WHITE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Params:
    weights: tuple[int, ...] = (1, 2, 3)       # by the source's place in code point order, repeating
    max_repeat: int = 3
    # per source, repeating: (time, weight) knots of its schedule
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
        ((0.0, 2.0), (0.25, 1.0), (1.0, 0.5)),
    )


def trimmed(text: str) -> Column:
    return F.expr(f"trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM coalesce(`{text}`, ''))")


def word_count(text: str) -> Column:
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, WHITE))).cast("long")


def _source_key(column: str) -> Column:
    """A join key that keeps NULL apart from every text."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))


def order_key(column: str = "doc_id") -> Column:
    hashed = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.concat(hashed, F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.lit("")))


def row_hash(docs: DataFrame) -> Column:
    """Tells rows apart that share their doc_id (maps can't be hashed)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])


def targets(sources: DataFrame, params: Params = Params()) -> DataFrame:
    """``sources`` (source, source_size) plus ``source_no``, ``weight`` and
    ``target``. Only sums over the sources reach the driver."""
    ranked = global_index(sources, [F.col("source").isNull(), "source"], "source_no", "_n").drop("_n")
    weights = F.array(*[F.lit(w) for w in params.weights])
    table = (ranked.withColumn("weight", F.get(weights, (F.col("source_no") % len(params.weights)).cast("int")))
                   .withColumn("_cap", F.col("source_size") * params.max_repeat))
    level, total = 0.0, None
    while True:  # each round stops at least one more source
        full = F.col("_cap") <= F.lit(level) * F.col("weight")
        row = table.agg(F.sum("source_size"), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        total, capped, weight = (row[0] or 0), (row[1] or 0), (row[2] or 0)
        new = (total - capped) / weight if weight else level
        if new <= level:
            break
        level = new
    by_weight = F.lit(level) * F.col("weight")
    return table.withColumn("target", F.least(F.col("_cap").cast("double"), by_weight)).drop("_cap")


def _inverse(x: Column, knots) -> Column:
    """Time at which the schedule's integral reaches the share ``x``."""
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        pieces.append((t0, t1, w0, w1, area))
        area += (t1 - t0) * (w0 + w1) / 2
    out = None
    for t0, t1, w0, w1, before in reversed(pieces):
        rest = x * F.lit(area) - F.lit(before)
        slope = (w1 - w0) / (t1 - t0)
        t = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest))
        out = t if out is None else F.when(x * F.lit(area) < F.lit(after), t).otherwise(out)
        after = before
    return out


def position(share: Column, source_no: str, params: Params) -> Column:
    n = len(params.schedules)
    return reduce(lambda rest, k: F.when(F.col(source_no) % n == k, _inverse(share, params.schedules[k])).otherwise(rest),
                  range(n), F.lit(None).cast("double"))


def mix(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", tie: Column | None = None, row: str | None = None) -> DataFrame:
    """Per row of ``docs``: id, source, size, source_size, source_no, target,
    taken, ``copies`` (words taken of each copy) and ``position`` of the first
    copy (NULL if none), not sorted. Rows with equal id and size are ordered
    by ``tie``, then by ``row``, a unique number (by default one is made)."""
    sized = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
                                    (F.lit(0) if tie is None else tie).cast("long").alias("_tie"),
                                    (F.monotonically_increasing_id() if row is None else F.col(row)).alias("_no")))
    sized = sized.withColumn("_src", _source_key("source")).withColumn("_key", order_key("id"))
    tagged = range_tag(sized, ["_src", "_key", "size", "_tie", "_no"])
    ranges = cut_lineage(tagged.groupBy("_src", "_pid").agg(F.sum("size").alias("_sum"), F.min("source").alias("source")))
    aims = targets(ranges.groupBy("_src").agg(F.min("source").alias("source"), F.sum("_sum").alias("source_size")), params)
    before = ranges.select("_src", "_pid", (F.sum("_sum").over(Window.partitionBy("_src").orderBy("_pid")) - F.col("_sum")).alias("_before"))
    before = before.join(aims.drop("source"), "_src")     # at most one row per source and partition
    run = Window.partitionBy("_src", "_pid").orderBy("_local").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (tagged.withColumn("_at", F.sum("size").over(run) - F.col("size")).join(before, ["_src", "_pid"])
                 .withColumn("_at", F.col("_at") + F.col("_before"))
                 .withColumn("_aim", F.round("target").cast("long")))
    part = lambda p: F.greatest(F.lit(0), F.least(F.col("size"), F.col("_aim") - F.col("_at") - F.col("source_size") * p))
    copies = F.filter(F.array(*[part(p) for p in range(params.max_repeat)]), lambda w: w > 0)
    rows = rows.withColumn("copies", copies)
    first = (F.col("_at") + F.get("copies", F.lit(0)) / 2) / F.col("_aim")
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "source_no", "target",
                       F.aggregate("copies", F.lit(0).cast("long"), lambda a, w: a + w).alias("taken"), "copies", "_at", "_no", "_aim",
                       F.when(F.size("copies") > 0, position(first, "source_no", params)).alias("position"))


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Range-sorted by position; documents that aren't taken come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), id_col)


def take(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` in training order, every row repeated as often as it is taken
    (a copy cut by the target counts if at least half of it is taken). Each
    copy stands at the position that the curriculum gives to the middle of its
    words; the copies are range-sorted by position, ties by row. Rows are
    numbered and written once, so that texts and positions are matched by a
    unique number whatever ids the rows share."""
    row, at = (next(n for n in (f"__mix_{name}{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for name in ("row", "at"))
    rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    mixed = mix(rows, params, tie=row_hash(docs), row=row)
    copies = (mixed.select("_no", "size", "source_size", "source_no", "_at", "_aim", F.posexplode("copies").alias("_copy", "_words"))
                   .filter(F.col("_words") * 2 >= F.col("size"))
                   .select(F.col("_no").alias(row),
                           position((F.col("_copy") * F.col("source_size") + F.col("_at") + F.col("_words") / 2) / F.col("_aim"), "source_no", params).alias(at)))
    return rows.join(cut_lineage(copies), row).orderBy(at, row).select(*docs.columns)
