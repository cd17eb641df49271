"""Order statistics without a single-partition window.

``F.ntile(5).over(Window.orderBy(...))`` and ``percentile`` gather every row
(or every distinct value) into one task. At customer-table scale that task is
the bottleneck, so the operators here compute an exact global 0-based index:

1. range-repartition on the full (total) sort key; ties of the leading value
   are split across partitions by the tie-break key, so a value shared by a
   third of all rows still spreads over many tasks;
2. sort within each partition and tag every row with its partition id and
   local position (``monotonically_increasing_id`` packs both);
3. materialise the tagged rows in the session's checkpoint folder, so the
   row-to-partition assignment never changes between the jobs that read it;
4. per-partition counts (one row per partition) -> running offsets -> a
   broadcast join whose size is bounded by the partition count.

NTILE buckets follow from (index, n); running sums (``prefix_sums``) use the
same partition offsets; exact quantiles and quantile bins run on running
counts of distinct values. Where only the rows at a few ranks are needed,
``selection`` finds them without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_GROUPS = 10_000  # groups whose statistics are broadcast; more are joined by shuffle
_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def _order_key(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_tag(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Range-partition and sort on ``order``; add ``_pid`` (partition) and
    ``_local`` (position inside it). Checkpointed so every later job sees the
    same assignment."""
    keys = [_order_key(c) for c in order]
    # Without an explicit count AQE may merge adjacent ranges into fewer,
    # larger partitions; the order survives because the tags are computed
    # after the (merged) shuffle read, in the same job that materialises them.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = (tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
                    .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                    .drop("_mid"))
    return cut_lineage(tagged) if checkpoint else tagged


def global_index(df: DataFrame, order: Sequence[str | Column], index_col: str = "_idx",
                 count_col: str = "_n", partitions: int | None = None,
                 checkpoint: bool = True) -> DataFrame:
    """Add the exact 0-based position of each row under ``order`` and the
    total row count. ``order`` must be a total order (end with a unique key)
    for the index to be reproducible."""
    tagged = range_tag(df, order, partitions, checkpoint)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    # At most one row per partition: the running sum runs on a bounded frame.
    offsets = counts.select(
        "_pid",
        (F.sum("_c").over(Window.orderBy("_pid")) - F.col("_c")).alias("_off"),
        F.sum("_c").over(Window.partitionBy()).alias(count_col),
    )
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(index_col, F.col("_off") + F.col("_local"))
                  .drop("_pid", "_local", "_off"))


def prefix_sums(df: DataFrame, order: Sequence[str | Column], value_cols: Sequence[str],
                prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` under ``order`` (a total
    order), plus grand totals ``total_<col>``. Local running sums are taken
    per range partition (rows stay with their partition), partition totals
    become offsets on a frame of one row per partition."""
    return with_prefix_sums(range_tag(df, order, partitions), value_cols, prefix)


def with_prefix_sums(tagged: DataFrame, value_cols: Sequence[str], prefix: str, keep_tags: bool = False) -> DataFrame:
    """``prefix_sums`` of rows that ``range_tag`` has sorted and tagged."""
    cols = list(value_cols)
    w = Window.partitionBy("_pid").orderBy("_local").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in cols])
    totals = tagged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = Window.orderBy("_pid")
    offsets = totals.select(
        "_pid",
        *[(F.sum(f"_t_{c}").over(before) - F.col(f"_t_{c}")).alias(f"_o_{c}") for c in cols],
        *[F.sum(f"_t_{c}").over(Window.partitionBy()).alias(f"total_{c}") for c in cols])
    out = local.join(F.broadcast(offsets), "_pid")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_l_{c}") + F.col(f"_o_{c}"))
    return out.drop(*[] if keep_tags else ["_pid", "_local"], *[f"_l_{c}" for c in cols], *[f"_o_{c}" for c in cols])


def ntile_from_index(idx: str, n: str, buckets: int) -> Column:
    """Standard NTILE bucket of a 0-based index: the first ``n mod b`` buckets
    hold ``n div b + 1`` rows, the rest ``n div b`` (if n < b, bucket = i+1)."""
    b = int(buckets)
    return F.expr(
        f"CASE WHEN {idx} < ({n} % {b}) * ({n} div {b} + 1) "
        f"THEN {idx} div ({n} div {b} + 1) + 1 "
        f"ELSE ({n} % {b}) + ({idx} - ({n} % {b}) * ({n} div {b} + 1)) div nullif({n} div {b}, 0) + 1 END"
    ).cast("int")


def ntile(df: DataFrame, buckets: int, order: Sequence[str | Column], out: str,
          partitions: int | None = None) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` computed distributed; every
    input column is carried through."""
    ranked = global_index(df, order, "_idx", "_n", partitions)
    return ranked.withColumn(out, ntile_from_index("_idx", "_n", buckets)).drop("_idx", "_n")


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    group_cols: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (``PERCENTILE_CONT``,
    ``quantile_cont``, numpy ``linear``) of ``value`` per group.

    Position ``p * (n - 1)`` inside the group's sorted values; NULLs ignored.
    Rows are first counted per distinct (group, value) - a value held by a
    third of all rows collapses to one row map-side - then running counts
    over the distinct values locate each requested position; only the
    distinct values around those positions reach the final aggregate.
    """
    group_cols = list(group_cols)
    base = df.select(*group_cols, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = base.groupBy(*group_cols, "_v").agg(F.count(F.lit(1)).alias("_c"))
    tagged = range_tag(counts, [*group_cols, "_v"], partitions)
    cum = with_prefix_sums(tagged, ["_c"], "_cum")  # -> _cum_c (inclusive)
    if group_cols:
        # One row per group, from the tagged rows (no second running count).
        stats = cut_lineage(tagged.groupBy(*group_cols).agg(F.sum("_c").alias("_ng")))
        if stats.count() <= MAX_GROUPS:
            before = Window.orderBy(*group_cols)  # the order of the range sort
            stats = F.broadcast(stats.withColumn("_start", F.sum("_ng").over(before) - F.col("_ng")))
        else:
            starts = cum.groupBy(*group_cols).agg(F.min(F.col("_cum_c") - F.col("_c")).alias("_start"))
            stats = stats.join(starts, group_cols)
        joined = cum.join(stats, group_cols)
    else:
        joined = cum.withColumn("_ng", F.col("total__c")).withColumn("_start", F.lit(0).cast("long"))
    # 0-based positions covered by this distinct value: [_first, _last]
    joined = (joined.withColumn("_last", F.col("_cum_c") - F.col("_start") - 1)
                    .withColumn("_first", F.col("_last") - F.col("_c") + 1))
    covers = lambda k: (F.col("_first") <= k) & (k <= F.col("_last"))
    conds, aggs = [], []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_ng") - 1).cast("double")
        lo, hi = F.floor(pos), F.ceil(pos)
        conds += [covers(lo), covers(hi)]
        v_lo = F.max(F.when(covers(lo), F.col("_v")))
        v_hi = F.max(F.when(covers(hi), F.col("_v")))
        frac = F.first(pos - lo)
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(name))
    keep = conds[0]
    for c in conds[1:]:
        keep = keep | c
    picked = joined.where(keep)
    if group_cols:
        return picked.groupBy(*group_cols).agg(*aggs)
    return picked.agg(*aggs)


def quantile_edges(df: DataFrame, value: str, q: int, partitions: int | None = None) -> DataFrame:
    """One-row frame with the q+1 equal-frequency edges (min .. max) as columns
    ``e0..eq``."""
    probs = {f"e{i}": i / q for i in range(q + 1)}
    return exact_quantiles(df, value, probs, partitions=partitions)


def qcut(df: DataFrame, value: str, q: int, out: str, check_unique: bool = True,
         partitions: int | None = None) -> DataFrame:
    """``pd.qcut(x, q, labels=False) + 1``: right-closed equal-frequency bins,
    the lowest edge included. Duplicate edges raise like pandas does (the q+1
    edges are the only values brought to the driver). The input is read by
    the edge sort and by the labelling, so it is materialised once."""
    df = cut_lineage(df)
    edges = quantile_edges(df, value, q, partitions)
    if check_unique:
        row = edges.collect()[0]
        vals = [row[f"e{i}"] for i in range(q + 1)]
        if len(set(vals)) != len(vals):
            raise ValueError(f"Bin edges must be unique: {vals}")
    inner = edges.select(F.array(*[F.col(f"e{i}") for i in range(1, q)])).scalar()
    # the edges are attached as a column first: a subquery may not sit inside a lambda
    return (df.withColumn("_edges", inner)
              .withColumn(out, (F.lit(1) + F.size(F.filter("_edges", lambda e: F.col(value) > e))).cast("int"))
              .drop("_edges"))
