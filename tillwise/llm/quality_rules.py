"""Quality rules with risk-controlled thresholds (operator 4). DataFrame
functions only.

Each rule compares one measure of a text with a cutoff. Cutoffs are not set by
hand: among the candidates of a rule the strictest one is taken whose false
rejection of good documents is proven small in each stratum (language). The
proof is an exact one-sided binomial test on the labelled rows of the stratum:
with k of n good documents rejected, the cutoff is certified if
P(Binomial(n, limit) <= k) <= error, which is the exact (Clopper-Pearson)
upper confidence bound at ``limit``. The limit of a stratum is divided among
its rules, and the error among the rules of all strata (Bonferroni); a rule's
candidates are tested as a fixed sequence, the loosest first, until one fails,
which needs no correction, since they are nested. So with probability 1 - ``error`` all selected rules together
reject at most ``limit`` of the good documents of every stratum. A cutoff must
also reject ``gain`` times the share of bad documents, else the rule stays off.

Measures are taken from whole texts inside the row: repeated 8-word windows
are found by hashing each window, sorting the hashes of the text with their
positions and summing the words they cover.

Edge cases: a NULL or empty text has no words and fails the base rule; a NULL
language is a stratum of its own; strata without enough labels to certify
anything only apply the base rule; a document labelled twice counts once (the
larger label). Repeated rows are judged alike. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .mixing import WHITE, trimmed

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    top: str                     # rejected if top > cutoff * bottom
    bottom: str
    cutoffs: tuple[float, ...]   # from the loosest to the strictest


@dataclass(frozen=True)
class Params:
    window: int = 8
    min_words: int = 20          # base rule
    max_repeat_pct: int = 30     # base rule
    limit: float = 0.02          # of a stratum's good documents, all rules together
    error: float = 0.05          # probability that any limit is broken
    gain: float = 10.0
    max_broadcast: int = 10_000  # strata; above, cutoffs are joined by shuffle
    rules: tuple[Rule, ...] = (
        Rule("symbols", "n_symbols", "word_chars", (0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05, 0.03, 0.02, 0.01)),
        Rule("dup_lines", "n_dup_lines", "n_words", (0.5, 0.3, 0.2, 0.12, 0.08, 0.05, 0.03, 0.02, 0.01)),
        Rule("repeats", "n_repeat_words", "n_words", (0.28, 0.25, 0.22, 0.19, 0.16, 0.13, 0.1, 0.07, 0.04, 0.02)),
        Rule("long_words", "word_chars", "n_words", (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0)),
        Rule("short_words", "n_words", "word_chars", (0.9, 0.7, 0.55, 0.45, 0.4, 0.36, 0.33, 0.3, 0.28, 0.26)),
    )


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), params: Params = Params(), text_col: str = "text") -> DataFrame:
    """``keep`` columns and the five measures of every row. Write the result
    before filtering on a measure: a pushed-down filter computes it again."""
    k = params.window
    d = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    bare = F.regexp_replace("_t", WHITE, "")
    lines = F.filter(F.split("_t", "\n"), lambda x: F.expr("''") != F.regexp_replace(x, WHITE, ""))
    d = (d.withColumn("_w", F.when(trimmed("_t") == "", F.array().cast("array<string>")).otherwise(F.split(trimmed("_t"), WHITE)))
          .withColumn("_lines", lines)
          .select(*keep, "_w", F.size("_w").cast("long").alias("n_words"), F.length(bare).cast("long").alias("word_chars"),
                  (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
                  (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines")))
    d = d.withColumn("_h", F.when(F.size("_w") >= k, F.expr(f"transform(sequence(1, size(_w) - {k - 1}), i -> xxhash64(slice(_w, i, {k})))")))
    d = d.withColumn("_z", F.when(F.size("_h") > F.size(F.array_distinct("_h")),
                                  F.expr("sort_array(transform(_h, (h, i) -> struct(h AS h, i AS i)))")))
    again = F.expr("filter(_z, (z, j) -> (j > 0 AND get(_z, j - 1).h = z.h) OR get(_z, j + 1).h = z.h)")
    d = d.withColumn("_at", F.when(F.col("_z").isNotNull(), F.sort_array(F.transform(again, lambda z: z["i"]))))
    covered = F.expr(f"aggregate(_at, named_struct('last', -{k}, 'n', 0L), "
                     f"(a, i) -> named_struct('last', i, 'n', a.n + least({k}, i - a.last)), a -> a.n)")
    return d.select(*keep, *MEASURES[:4], F.coalesce(F.when(F.col("_at").isNotNull(), covered), F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed(params: Params = Params()) -> Column:
    return (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_pct * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series at x + 7, brought back down."""
    z = x + 7
    low = x
    for i in range(1, 7):
        low = low * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(low)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact to double precision; 1 where k is so near
    the mean or above that the terms below k don't fall off (never certified)."""
    k, n = k.cast("double"), n.cast("double")
    log_pmf = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = k * (1 - p) / ((n - k + 1) * p)   # of the term below k to the term at k; later ratios are smaller
    terms = F.when(k == 0, 0).otherwise(F.least(k, F.ceil(F.lit(-40.0) / F.log(ratio)))).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    tail = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
                       lambda a, j: _next_term(a, k, n, p, j), lambda a: a["sum"])
    return F.when(ratio >= 0.999, F.lit(1.0)).otherwise(F.exp(log_pmf) * tail)


def _next_term(a: Column, k: Column, n: Column, p: float, j: Column) -> Column:
    term = a["term"] * (k - j + 1) * (1 - p) / ((n - k + j) * p)
    return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))


def select_cutoffs(labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """``labelled``: stratum, the measures and quality (0/1). Returns one row
    per stratum that has any certified rule: ``cutoffs``, rule -> cutoff."""
    hits = [F.struct(F.lit(r.name).alias("rule"),
                     sum((F.col(r.top) > F.lit(c) * F.col(r.bottom)).cast("int") for c in r.cutoffs).alias("level"))
            for r in params.rules]
    counted = cut_lineage(labelled.select("stratum", "quality", F.explode(F.array(*hits)).alias("x"))
                                  .groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.level").alias("level"))
                                  .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")))
    # a row that exceeds ``level`` cutoffs is rejected by the strictest ``level`` ones, which come last
    sizes = counted.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    # A rule's candidates are nested, so the bound only grows from the loosest on: testing them in that order until
    # one fails (a fixed sequence) needs no correction among them, only one for the rules of all strata.
    tests = sizes.count()
    cutoffs = F.create_map(*[x for r in params.rules for x in (F.lit(r.name), F.array(*[F.lit(c) for c in r.cutoffs]))])
    n = F.size(F.element_at(cutoffs, F.col("rule")))
    per = (counted.filter("level > 0").withColumn("j", F.explode(F.sequence(n - F.col("level") + 1, n)))
                  .groupBy("stratum", "rule", "j").agg(F.sum("good").alias("k_good"), F.sum("bad").alias("k_bad"))
                  .join(sizes, ["stratum", "rule"]))
    error = params.error / max(1, tests)
    certified = per.filter((F.col("n_good") > 0) & (binomial_cdf(F.col("k_good"), F.col("n_good"), params.limit / len(params.rules)) <= error)
                           & (F.col("k_bad") * F.col("n_good") > F.lit(params.gain) * F.col("k_good") * F.col("n_bad")))
    best = certified.groupBy("stratum", "rule").agg(F.max("j").alias("j"))
    return (best.select("stratum", "rule", F.get(F.element_at(cutoffs, F.col("rule")), F.col("j") - 1).alias("cutoff"))
                .groupBy("stratum").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "cutoff")))).alias("cutoffs")))


def _stratum(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))


def judge(docs: DataFrame, labels: DataFrame, params: Params = Params(), stratum_col: str = "lang") -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of ``docs``."""
    measured = cut_lineage(measure(docs.select("doc_id", "text", _stratum(stratum_col).alias("stratum")), ("doc_id", "stratum"), params))
    y = (labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
               .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    chosen = cut_lineage(select_cutoffs(measured.filter(~base_failed(params)).join(y, "doc_id"), params))
    if chosen.count() <= params.max_broadcast:
        chosen = F.broadcast(chosen)
    out = measured.join(chosen, "stratum", "left")
    rejected = F.lit(False)
    for r in params.rules:
        rejected = rejected | F.coalesce(F.col(r.top) > F.col("cutoffs")[r.name] * F.col(r.bottom), F.lit(False))
    return out.select("doc_id", *MEASURES, base_failed(params).alias("base_failed"), (~base_failed(params) & ~rejected).alias("kept"))
