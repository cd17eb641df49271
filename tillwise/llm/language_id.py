"""Language identification: multinomial naive Bayes over hashed character
n-grams (operator 10).

Counts of n-gram buckets per language are summed on the executors over all
labelled documents, and every label is learned; the log-probability matrix
(languages x buckets, 0.4 MB a language) is broadcast, and documents are scored
batch by batch
in numpy: each text is a sparse row of n-gram occurrences whose columns of the
matrix are gathered and summed.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0;
without any labelled document every text is ``und``; a text holding letters
always gets a learned language (ties: the first by code point). Repeated rows
are scored alike and each counts when learning. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textio

UNDETERMINED = "und"


@dataclass(frozen=True)
class Params:
    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 15
    smoothing: float = 0.5
    held_languages: int = 64   # whose counts a task holds at a time


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray       # (len(orders) << bits, languages), float32
    params: Params


def _grams(texts: list[str], p: Params):
    """Per n-gram order: bucket column of every occurrence, text bounds."""
    cp, offsets = textio.code_points([t.lower() for t in texts])
    for i, n in enumerate(p.orders):
        ids, s, e = textio.ngram_buckets(cp, offsets, n, p.bits)
        yield ids.astype(np.int64) + (i << p.bits), s, e


def fit(train: DataFrame, params: Params = Params(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """``train``: labelled documents; rows with a NULL language don't count."""
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("lang IS NOT NULL")
    seen = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}   # one number per label
    languages = sorted(seen)
    width = len(params.orders) << params.bits

    def emit(acc):
        for lang, v in acc.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(v[at], pa.int64())],
                names=["lang", "col", "n"])

    def tally(batches):
        acc: dict[str, np.ndarray] = {}
        for b in textio.text_pieces(batches, "text"):
            langs = np.array(b.column("lang").to_pylist(), dtype=object)
            for lang in set(langs):
                texts = [t for t, x in zip(textio.texts_of(b), langs) if x == lang]
                v = acc.setdefault(lang, np.zeros(width, dtype=np.int64))
                for ids, s, e in _grams(texts, params):
                    inside = np.zeros(len(ids) + 1, dtype=np.int64)
                    np.add.at(inside, s, 1)
                    np.add.at(inside, np.minimum(e, len(ids)), -1)
                    v += np.bincount(ids[np.cumsum(inside[:-1]) > 0], minlength=width)
                if len(acc) >= params.held_languages:
                    yield from emit(acc)
                    acc = {}
        yield from emit(acc)

    n_docs = np.array([seen[x] for x in languages], dtype=np.float64)
    if not languages:
        return Model(languages, n_docs, np.zeros((width, 0), dtype=np.float32), params)
    codes = F.broadcast(train.sparkSession.createDataFrame(list(enumerate(languages)), "code int, lang string"))
    got = (rows.mapInArrow(tally, "lang string, col int, n long").groupBy("lang", "col").agg(F.sum("n").alias("n"))
               .join(codes, "lang").select("code", "col", "n").toArrow())
    lang, col, n = (np.asarray(got.column(c)) for c in ("code", "col", "n"))
    total = np.log(np.bincount(lang, weights=n, minlength=len(languages)) + params.smoothing * width)
    log_prob = np.tile((np.log(params.smoothing) - total).astype(np.float32), (width, 1))   # n-grams never seen
    log_prob[col, lang] = np.log(n + params.smoothing) - total[lang]
    return Model(languages, np.log(n_docs / n_docs.sum()), log_prob, params)


def score_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its posterior probability per text."""
    log_joint = np.tile(model.log_prior, (len(texts), 1))
    for ids, s, e in _grams(texts, model.params):
        log_joint += textio.segment_sums(model.log_prob[ids], s, e)
    best = log_joint.argmax(axis=1)
    rel = np.exp(log_joint - log_joint.max(axis=1, keepdims=True))
    return best, rel[np.arange(len(texts)), best] / rel.sum(axis=1)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` for every row."""

    def run(batches):  # the model travels with the function: Spark broadcasts it once
        m = model
        names = np.array([*m.languages, UNDETERMINED], dtype=object)
        for b in textio.text_pieces(batches, "_text", (8 << 20) // max(8, len(m.languages))):
            col = b.column("_text")
            known = np.asarray(pc.fill_null(pc.match_substring_regex(col, r"\p{L}"), False)) & bool(m.languages)
            best = np.full(len(b), len(m.languages), dtype=np.int64)
            score = np.zeros(len(b))
            if known.any():
                best[known], score[known] = score_texts(m, [t for t, k in zip(textio.texts_of(b, "_text"), known) if k])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(names[best], pa.string()),
                                              pa.array(score)], names=[*keep, "lang_pred", "score"])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, lang_pred string, score double")
