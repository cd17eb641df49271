"""Model preparation and evaluation as DataFrame jobs.

Splits, folds, class weights, scaling, and exact metrics (confusion counts,
per-class report, rank-sum AUC with tied ranks averaged, ROC and
precision-recall points) computed over (label, score) frames of any size:
grouping by score is partial-aggregated and running sums use range
partitions, never a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import selection
from .ranking import global_index, prefix_sums, range_tag, with_prefix_sums


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the exact median of each column (all rows). ``df`` is
    read by the medians and by the fill: pass a written table."""
    out = df
    for c, m in selection.quantiles(df, list(columns)).items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")))
    return out


def stratified_split(df: DataFrame, label: str, key: str, seed: int = 42,
                     train_fraction: float = 0.8, folds: int = 5) -> DataFrame:
    """Deterministic stratified split: inside each class rows are ordered by
    ``md5(key|seed)``; the last ``ceil((1 - train_fraction) * n_class)`` are
    test (exact rational arithmetic, no float rounding at the cut). Train
    rows get a stratified fold number ``position mod folds``.
    Adds ``is_train`` and ``fold`` (NULL for test rows)."""
    test = Fraction(1) - Fraction(str(train_fraction))
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    ranked = global_index(df.withColumn("_h", h), [F.col(label), F.col("_h"), F.col(key)], "_idx", "_n")
    stats = ranked.groupBy(label).agg(F.min("_idx").alias("_start"), F.count(F.lit(1)).alias("_nc"))
    j = ranked.join(F.broadcast(stats), label)  # one row per class
    pos = F.col("_idx") - F.col("_start")
    n_test = F.expr(f"(_nc * {test.numerator} + {test.denominator - 1}) div {test.denominator}")
    is_train = pos < (F.col("_nc") - n_test)
    return (j.withColumn("is_train", is_train)
             .withColumn("fold", F.when(is_train, (pos % folds).cast("int")))
             .drop("_h", "_idx", "_n", "_start", "_nc"))


def train_test_cut(df: DataFrame, label: str, key: str, seed: int = 42, train_fraction: float = 0.8) -> DataFrame:
    """``is_train`` of ``stratified_split`` without its folds: each class is cut
    at its first test row, which boundary refinement finds, so that no row is
    sorted, shuffled or written. ``df`` is read a few times: pass a written
    table. Rows without a label are left out."""
    test = Fraction(1) - Fraction(str(train_fraction))
    value, tie = "__cut_value", "__cut_tie"
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    keyed = (df.where(F.col(label).isNotNull()).withColumn(tie, F.concat(h, F.lit("|"), F.col(key).cast("string")))
               .withColumn(value, F.conv(F.substring(h, 1, 12), 16, 10).cast("double")))     # 48 bits: exact
    classes = {str(r[0]): r[0] for r in keyed.select(label).distinct().collect()}             # a row per class
    if not classes:
        return keyed.drop(value, tie).withColumn("is_train", F.lit(False))

    def first_test(_, n: int) -> list[int]:
        return [n - -(-n * test.numerator // test.denominator)]

    found = selection.at_ranks(keyed, {name: F.when(F.col(label) == c, F.col(value)) for name, c in classes.items()},
                               first_test, tie)
    train = F.lit(True)
    for name, c in classes.items():
        for v, k in found[name][1].values():
            before = (F.col(value) < v) | ((F.col(value) == v) & (F.col(tie) < k))
            train = F.when(F.col(label) == c, before).otherwise(train)
    return keyed.withColumn("is_train", train).drop(value, tie)


def class_weight_table(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """One row per class: balanced weight n / (2 * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc")).scalar()
    return counts.select(
        label, F.col("_nc").cast("long").alias("class_count"),
        (total.cast("double") / (F.lit(2.0) * F.col("_nc"))).alias(out))


def fit_standardizer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-row frame of means and population standard deviations."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_pop(c).alias(f"_std_{c}")]
    return df.agg(*aggs)


def apply_standardizer(df: DataFrame, stats: DataFrame, columns: Sequence[str],
                       suffix: str = "_z") -> DataFrame:
    """(x - mean) / std with population std; a constant column scales to 0."""
    s = stats.select(F.struct(*stats.columns)).scalar()  # one row: scalar subquery
    out = df
    for c in columns:
        std = s[f"_std_{c}"]
        z = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - s[f"_mean_{c}"]) / std)
        out = out.withColumn(f"{c}{suffix}", z)
    return out


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    return apply_standardizer(df, fit_standardizer(df, columns), columns, suffix)


def confusion_metrics(df: DataFrame, label: str = "label", score: str = "score",
                      threshold: float = 0.5) -> DataFrame:
    """TP/FP/TN/FN at ``score > threshold`` and accuracy, precision, recall, F1
    (0 where undefined), one aggregate."""
    y, p = F.col(label) == 1, F.col(score) > F.lit(threshold)
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    prec = F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp))
    rec = F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn))
    return c.select(
        *[F.col(x).cast("long").alias(x) for x in ("tp", "fp", "tn", "fn")],
        F.round((tp + tn) / (tp + fp + tn + fn), 6).alias("accuracy"),
        F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
        F.round(F.when(tp == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn)), 6).alias("f1"))


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5, names=("Active", "Churned")) -> DataFrame:
    """Per-class precision, recall, F1 and support."""
    c = confusion_metrics(df, label, score, threshold)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))

    def block(cls, name, tp_, fp_, fn_):
        prec = F.when(tp_ + fp_ == 0, 0.0).otherwise(tp_ / (tp_ + fp_))
        rec = F.when(tp_ + fn_ == 0, 0.0).otherwise(tp_ / (tp_ + fn_))
        f1 = F.when(tp_ == 0, 0.0).otherwise(2 * tp_ / (2 * tp_ + fp_ + fn_))
        return F.struct(F.lit(cls).cast("int").alias("class"), F.lit(name).alias("class_name"),
                        F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                        F.round(f1, 6).alias("f1"), (tp_ + fn_).cast("long").alias("support"))

    rows = F.array(block(0, names[0], tn, fn, fp), block(1, names[1], tp, fp, fn))
    return c.select(F.inline(rows))


def score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score with positive and negative counts."""
    y = F.col(label).cast("long")
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def auc_rank(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC by the rank-sum (Mann-Whitney) formula with tied scores
    sharing their average rank."""
    base = df.select(F.col(score).alias("_s"), F.col(label).cast("long").alias("_y"))
    g = score_groups(base, "_y", "_s").withColumn("_c", F.col("pos") + F.col("neg"))
    cum = prefix_sums(g, [F.col("score").asc()], ["_c"], "cum")
    # ranks of a tie group: cum - c + 1 .. cum; their mean is cum - (c - 1) / 2
    avg_rank = F.col("cum_c") - (F.col("_c") - 1).cast("double") / 2
    agg = cum.agg(F.sum(F.col("pos") * avg_rank).alias("_r"), F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    p, q = F.col("_p").cast("double"), F.col("_q").cast("double")
    auc = (F.col("_r") - p * (p + 1) / 2) / (p * q)
    return agg.select(F.round(auc, 9).alias("auc"), F.col("_p").cast("long").alias("positives"),
                      F.col("_q").cast("long").alias("negatives"))


def auc_by_group(df: DataFrame, group: str, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC per value of ``group`` for scores rounded to a few
    decimals: a group has at most 10^decimals + 1 distinct scores, so after
    the partial aggregation the running counts of a group are a bounded window.
    NULL where a group holds one class only."""
    y = F.col(label).cast("long")
    g = df.groupBy(group, F.col(score).alias("_s")).agg(F.sum(y).alias("_p"), F.count(F.lit(1)).alias("_c"))
    cum = g.withColumn("_cum", F.sum("_c").over(Window.partitionBy(group).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.col("_cum") - (F.col("_c") - 1).cast("double") / 2        # the mean rank of a tie
    agg = cum.groupBy(group).agg(F.sum(F.col("_p") * rank).alias("_r"), F.sum("_p").cast("double").alias("_p"), F.sum("_c").cast("double").alias("_n"))
    p, n = F.col("_p"), F.col("_n")
    return agg.select(group, F.when((p > 0) & (p < n), (F.col("_r") - p * (p + 1) / 2) / (p * (n - p))).alias("auc"))


def curve_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC and precision-recall points at every distinct score threshold
    (predict positive when score >= threshold), highest threshold first,
    plus the origin at threshold +inf."""
    base = df.select(F.col(score).alias("_s"), F.col(label).cast("long").alias("_y"))
    g = score_groups(base, "_y", "_s")
    cum = prefix_sums(g, [F.col("score").desc()], ["pos", "neg"], "cum_")
    tps, fps = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    P, N = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    pts = cum.select(
        F.col("score").alias("threshold"), F.col("cum_pos").cast("long").alias("tps"),
        F.col("cum_neg").cast("long").alias("fps"),
        F.round(F.when(N == 0, 0.0).otherwise(fps / N), 9).alias("fpr"),
        F.round(F.when(P == 0, 0.0).otherwise(tps / P), 9).alias("tpr"),
        F.round(tps / (tps + fps), 9).alias("precision"))
    spark = df.sparkSession
    origin = spark.createDataFrame(
        [(float("inf"), 0, 0, 0.0, 0.0, 1.0)],
        "threshold double, tps long, fps long, fpr double, tpr double, precision double")
    return pts.unionByName(origin).withColumn("recall", F.col("tpr"))


def reduced_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC points without those that lie between two others in a straight step:
    a point stays if it is the first or the last, or if the next threshold adds
    other numbers of positives or negatives than its own did. The next row of
    the last row of a range partition is the first row of the next partition
    that has one (one small row per partition), so no window spans them."""
    base = df.select(F.col(score).alias("_s"), F.col(label).cast("long").alias("_y"))
    tagged = range_tag(score_groups(base, "_y", "_s"), [F.col("score").desc()])
    cum = with_prefix_sums(tagged, ["pos", "neg"], "cum_", keep_tags=True)
    step = F.struct("pos", "neg")
    heads = tagged.where(F.col("_local") == 0).select("_pid", step.alias("_head"))
    heads = heads.withColumn("_after", F.lead("_head").over(Window.orderBy("_pid"))).drop("_head")       # one row per partition
    rows = Window.partitionBy("_pid").orderBy("_local")
    near = (cum.withColumn("_step", step).withColumn("_next", F.lead("_step").over(rows))
               .join(F.broadcast(heads), "_pid", "left").withColumn("_next", F.coalesce("_next", "_after")))
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    kept = near.where(first | F.col("_next").isNull() | (F.col("_next") != F.col("_step")))
    tps, fps = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    P, N = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    points = kept.select(F.col("score").alias("threshold"), F.round(F.when(N == 0, 0.0).otherwise(fps / N), 9).alias("fpr"),
                         F.round(F.when(P == 0, 0.0).otherwise(tps / P), 9).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return points.unionByName(origin)


def split_summary(split: DataFrame, label: str) -> DataFrame:
    """Rows and positive-label rate of the train and test parts."""
    return split.groupBy(F.when(F.col("is_train"), "train").otherwise("test").alias("part")).agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.round(F.avg(F.col(label).cast("double")), 6).alias("churn_rate"))
