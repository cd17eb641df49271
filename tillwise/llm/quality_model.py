"""Quality classifier: supervised subword embeddings (operator 5).

Every word, every pair of neighbouring words and every character n-gram hashes
to a learned vector; a document is the average of the vectors of all its
features, and a softmax layer turns it into class probabilities. Vectors and
layer are trained together by stochastic gradient descent in numpy on a bounded
sample of labelled documents, which executors reduce to hashed counts first (at
most one entry per bucket and document, so the driver never sees a text).

Softmax of an average is linear in the average, so for scoring each bucket's
vector is multiplied into the layer once; a document's logit is then the mean
of one number per bucket occurrence. The whole text is read.

Edge cases: NULL and empty texts get the learned class prior; without labels
of both classes every text gets the prior (0.5 without any label). Repeated
rows score alike; repeated labels of one document count once (the largest).
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textio


@dataclass(frozen=True)
class Params:
    orders: tuple[int, ...] = (2, 3)
    bits: int = 16             # buckets per feature family (words, word pairs, each n-gram order)
    dim: int = 8
    epochs: int = 8
    rate: float = 0.5
    max_docs: int = 4_000      # bound of the labelled sample
    seed: int = 7


@dataclass
class Model:
    logit: np.ndarray          # per bucket: its vector times (class 1 - class 0)
    bias: float
    params: Params


def _features(texts: list[str], p: Params):
    """Per feature family: bucket ids of all occurrences, text bounds."""
    cp, offsets = textio.code_points(texts)
    starts, hashes = textio.word_hashes(cp, offsets)
    at = np.searchsorted(starts, offsets)
    word = hashes[0]
    yield textio.bucket(word, p.bits, 0).astype(np.int64), at[:-1], at[1:]
    pair = word[:-1] * textio.BASE + word[1:]
    yield (textio.bucket(pair, p.bits, 1).astype(np.int64) + ((len(p.orders) + 1) << p.bits),
           at[:-1], np.maximum(at[1:] - 1, at[:-1]))
    for i, n in enumerate(p.orders, 1):
        ids, s, e = textio.ngram_buckets(cp, offsets, n, p.bits)
        yield ids.astype(np.int64) + (i << p.bits), s, e


def hashed_counts(docs: DataFrame, params: Params, keep: str = "id long, label int") -> DataFrame:
    """``keep`` columns plus the document's distinct buckets and their counts."""
    names = [c.split()[0] for c in keep.split(",")]

    def run(batches):
        for b in textio.text_pieces(batches, "text"):
            texts = textio.texts_of(b)
            ids, counts = [[] for _ in texts], [[] for _ in texts]
            for f, s, e in _features(texts, params):
                for i in range(len(texts)):
                    u, c = np.unique(f[s[i]:e[i]], return_counts=True)
                    ids[i].append(u)
                    counts[i].append(c)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names],
                 pa.array([np.concatenate(x) for x in ids], pa.list_(pa.int32())),
                 pa.array([np.concatenate(x) for x in counts], pa.list_(pa.int32()))],
                names=[*names, "ids", "counts"])

    return docs.select(*names, "text").mapInArrow(run, f"{keep}, ids array<int>, counts array<int>")


def train(ids: list[np.ndarray], counts: list[np.ndarray], label: np.ndarray, p: Params) -> Model:
    """Plain SGD over documents, learning rate falling linearly to zero."""
    width = (len(p.orders) + 2) << p.bits
    prior = (label.sum() + 0.5) / (len(label) + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(width), bias, p)
    rng = np.random.default_rng(p.seed)
    vec = rng.uniform(-1 / p.dim, 1 / p.dim, (width, p.dim)).astype(np.float32)
    layer = np.zeros((p.dim, 2), dtype=np.float32)
    offset = np.array([0.0, bias], dtype=np.float32)
    weight = [(c / max(c.sum(), 1)).astype(np.float32) for c in counts]
    steps, step = p.epochs * len(ids), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(ids)):
            rate = p.rate * (1 - step / steps)
            step += 1
            if not len(ids[i]):
                continue
            hidden = weight[i] @ vec[ids[i]]
            z = hidden @ layer + offset
            z = np.exp(z - z.max())
            err = (z / z.sum()).astype(np.float32)
            err[label[i]] -= 1
            back = layer @ err
            layer -= rate * np.outer(hidden, err)
            # a mean's gradient shrinks with the number of buckets; scale it back as for a bag of that size
            vec[ids[i]] -= (rate * len(ids[i])) ** 0.5 * np.outer(weight[i], back)
    return Model((vec @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(offset[1] - offset[0]), p)


def fit(labelled: DataFrame, params: Params = Params()) -> Model:
    """``labelled``: columns id, text, label (0 or 1), one row per document."""
    rows = textio.bounded_sample(labelled.select("id", "label"), "id", params.max_docs)
    texts = labelled.select("id", "label", F.coalesce("text", F.lit("")).alias("text")).join(rows.select("id"), "id", "left_semi")
    got = hashed_counts(texts, params).toArrow().sort_by("id")
    as_np = lambda c: [np.asarray(x.values, dtype=np.int64) for x in got.column(c)]
    return train(as_np("ids"), as_np("counts"), np.asarray(got.column("label"), dtype=np.int64), params)


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for f, s, e in _features(texts, model.params):
        total += textio.segment_sums(model.logit[f], s, e)
        n += e - s
    return textio.sigmoid(total / np.maximum(n, 1) + model.bias)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``score``, the probability of class 1."""

    def run(batches):
        for b in textio.text_pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(score_texts(model, textio.texts_of(b, "_text")))],
                names=[*keep, "score"])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, score double")


def labelled(docs: DataFrame, labels: DataFrame, column: str, usable: Column) -> DataFrame:
    """id, text, label of the documents that have a 0/1 label in ``column``
    and meet ``usable`` (on doc_id); one row per doc_id."""
    y = (labels.select("doc_id", F.col(column).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
               .groupBy("doc_id").agg(F.max("label").alias("label")))
    x = docs.select("doc_id", "text").filter("doc_id IS NOT NULL").filter(usable)
    integer = docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    number = F.col("doc_id").cast("long") if integer else F.xxhash64("doc_id")
    return (x.join(y, "doc_id").groupBy(number.alias("id"))
             .agg(F.max("label").alias("label"), F.min("text").alias("text")))
