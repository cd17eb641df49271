"""Toxicity: a chain of linear classifiers (operator 6).

Categories are predicted one after another. The model of a category sees the
document's hashed words and word beginnings and the probabilities of all
categories before it. While training, those earlier probabilities are
out-of-fold: each document's value comes from models that never saw it, so a
later model learns how far an earlier one can be trusted. For scoring, the
models fitted on all training rows feed each other in the same order.

The default categories are toxicity by language (the languages with the most
toxic labels first, all that have ``min_toxic`` of them in the sample), each with a vocabulary of its
own and learned from the rows of that language, and last ``toxic`` itself,
learned from all rows, which decides. The decision threshold maximises F1 of
the out-of-fold probabilities of the last category.

Features are presence flags (a long text is not diluted) of words and of
beginnings of 4, 5 and 6 characters, and of pairs and triples of characters in
scripts written without blanks, hashed; per category those whose presence
differs between the classes beyond a log-likelihood-ratio limit are kept.
Training runs in numpy on a bounded sample of labelled rows that executors
reduce to hashed features; scoring reads every whole text.

Edge cases: NULL and empty texts are scored by the intercept; a category
without both classes has a constant probability; without labels nothing is
toxic. Repeated rows score alike. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textio

TARGET = "toxic"
UNSPACED = 0x0E00    # Thai and what follows it in Unicode: mostly scripts without blanks between words


@dataclass(frozen=True)
class Params:
    prefixes: tuple[int, ...] = (4, 5, 6)
    bits: int = 20
    max_docs: int = 6_000        # bound of the labelled sample
    min_toxic: int = 1           # toxic labelled documents from which on a language has a link of its own
    folds: int = 5
    min_ratio: float = 14.0      # keep features whose log-likelihood ratio (G2) is above
    max_features: int = 2_000    # per category, the strongest
    l2: float = 2e-4
    steps: int = 250


@dataclass
class Link:
    name: str
    features: np.ndarray         # buckets, sorted
    weights: np.ndarray
    earlier: np.ndarray          # weights of the logits of earlier categories
    bias: float


@dataclass
class Chain:
    params: Params
    links: list[Link] = field(default_factory=list)
    threshold: float = 0.5


def _buckets(texts: list[str], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets and, for each, the number of its text."""
    cp, offsets = textio.code_points([t.lower() for t in texts])
    starts, hashes = textio.word_hashes(cp, offsets, p.prefixes)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ids, docs = [], []
    for k, h in hashes.items():
        there = h != 0
        ids.append(textio.bucket(h[there], p.bits, k))
        docs.append(doc[there])
    # scripts written without blanks: a run of letters is no word, so its pairs and triples of characters count too
    dense = textio.word_chars(cp) & (cp >= UNSPACED)
    if dense.any():
        of = np.searchsorted(offsets, np.arange(len(cp)), side="right") - 1
        for n in (2, 3):
            grams, _, _ = textio.ngram_buckets(cp, offsets, n, p.bits)
            at = np.flatnonzero(np.logical_and.reduce([dense[k:len(cp) - n + 1 + k] for k in range(n)])) if len(cp) >= n else np.zeros(0, np.int64)
            at = at[of[at] == of[at + n - 1]]
            ids.append(grams[at])
            docs.append(of[at])
    return np.concatenate(ids), np.concatenate(docs)


def features(rows: DataFrame, p: Params, keep: list[str]) -> DataFrame:
    """``keep`` columns and the sorted distinct feature buckets per row."""

    def run(batches):
        for b in textio.text_pieces(batches, "text"):
            ids, docs = _buckets(textio.texts_of(b), p)
            pair = np.unique((docs.astype(np.int64) << p.bits) | ids)
            cut = np.searchsorted(pair >> p.bits, np.arange(len(b) + 1)).astype(np.int32)
            flat = pa.array((pair & ((1 << p.bits) - 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(cut), flat)],
                                             names=[*keep, "ids"])

    src = rows.select(*keep, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "text")
    return src.mapInArrow(run, f"{kinds}, ids array<int>")


@dataclass
class Rows:
    """Presence features: bucket ids end to end, each with its row number."""
    n: int
    row: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, ids: list, bits: int) -> Rows:
        flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
        return cls(len(ids), np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids]), flat)

    def chosen(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature number) of the presences of ``features``."""
        at = np.searchsorted(features, self.ids)
        hit = (at < len(features)) & (features[np.minimum(at, len(features) - 1)] == self.ids) if len(features) else np.zeros(len(self.ids), bool)
        return self.row[hit], at[hit]


def _g2(rows: Rows, y: np.ndarray, use: np.ndarray, p: Params) -> np.ndarray:
    """Buckets whose presence depends on ``y`` among the rows ``use``."""
    a = np.bincount(rows.ids[(use & y)[rows.row]], minlength=1 << p.bits)
    b = np.bincount(rows.ids[(use & ~y)[rows.row]], minlength=1 << p.bits)
    n1, n0 = float((use & y).sum()), float((use & ~y).sum())
    seen = np.flatnonzero(a + b)
    a, b = a[seen].astype(float), b[seen].astype(float)
    share = (a + b) / (n1 + n0)
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    g = 2 * (part(a, n1 * share) + part(n1 - a, n1 * (1 - share)) + part(b, n0 * share) + part(n0 - b, n0 * (1 - share)))
    good = np.flatnonzero(g > p.min_ratio)
    good = good[np.argsort(-g[good], kind="stable")[:p.max_features]]
    return np.sort(seen[good])


def _fit_link(name: str, rows: Rows, earlier: np.ndarray, y: np.ndarray, use: np.ndarray, p: Params) -> Link:
    """L2 logistic regression (full-batch Adam) on the rows ``use``."""
    n1, n = float((use & y).sum()), float(use.sum())
    prior = float(np.log((n1 + 0.5) / (n - n1 + 0.5)))
    if n1 == 0 or n1 == n:
        return Link(name, np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), min(prior, -8.0) if n1 == 0 else prior)
    feats = _g2(rows, y, use, p)
    r, c = rows.chosen(feats)
    sel = use[r]
    r, c = r[sel], c[sel]
    k = len(feats)
    w = np.zeros(k + earlier.shape[1] + 1)
    w[-1] = prior
    m, v = np.zeros_like(w), np.zeros_like(w)
    t = y.astype(float)
    for step in range(1, p.steps + 1):
        z = np.bincount(r, weights=w[c], minlength=rows.n) + earlier @ w[k:-1] + w[-1]
        err = np.where(use, textio.sigmoid(z) - t, 0.0) / n
        g = np.concatenate([np.bincount(c, weights=err[r], minlength=k), earlier.T @ err, [err.sum()]])
        g[:-1] += p.l2 * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return Link(name, feats, w[:k], w[k:-1], float(w[-1]))


def _logit(link: Link, rows: Rows, earlier: np.ndarray) -> np.ndarray:
    r, c = rows.chosen(link.features)
    return np.bincount(r, weights=link.weights[c], minlength=rows.n) + earlier @ link.earlier + link.bias


def train(rows: Rows, key: np.ndarray, labels: dict[str, tuple[np.ndarray, np.ndarray]],
          p: Params = Params()) -> Chain:
    """``labels``: category -> (0/1 per row, rows to learn from), in chain
    order; the last decides. ``key`` assigns a row to its fold."""
    chain = Chain(p)
    if not rows.n:
        return chain
    fold = (np.asarray(key, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(p.folds)
    earlier = np.zeros((rows.n, 0))
    prob = np.zeros(rows.n)
    for name, (y, use) in labels.items():
        held = np.zeros(rows.n)
        for f in range(p.folds):
            out = fold == f
            if out.any() and not out.all():
                held[out] = _logit(_fit_link(name, rows, earlier, y, use & ~out, p), rows, earlier)[out]
        chain.links.append(_fit_link(name, rows, earlier, y, use, p))
        prob = textio.sigmoid(held)
        earlier = np.column_stack([earlier, prob])
    order = np.argsort(-prob, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, rows.n + 1) + y.sum()) if y.any() else np.zeros(rows.n)
    if y.any():
        best = int(f1.argmax())
        below = prob[order[best + 1]] if best + 1 < rows.n else 0.0
        chain.threshold = float(np.clip((prob[order[best]] + below) / 2, 0.05, 0.8))
    return chain


def predict_texts(chain: Chain, texts: list[str]) -> np.ndarray:
    """Probabilities, one column per category."""
    p = chain.params
    known = np.unique(np.concatenate([x.features for x in chain.links])) if chain.links else np.zeros(0, np.int64)
    flag = np.zeros(1 << p.bits, dtype=bool)
    flag[known] = True
    ids, docs = _buckets(texts, p)
    hit = flag[ids]
    pair = np.unique((docs[hit].astype(np.int64) << p.bits) | ids[hit])
    rows = Rows(len(texts), pair >> p.bits, pair & ((1 << p.bits) - 1))
    earlier = np.zeros((len(texts), 0))
    for link in chain.links:
        earlier = np.column_stack([earlier, textio.sigmoid(_logit(link, rows, earlier))])
    return earlier


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Chain:
    """``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic)."""
    y = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
               .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
                .join(textio.bounded_sample(y, "doc_id", params.max_docs), "doc_id")
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"), F.min("lang").alias("lang")))
    integer = docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    rows = rows.withColumn("key", F.col("doc_id").cast("long") if integer else F.xxhash64("doc_id"))
    got = features(rows, params, ["doc_id", "key", "toxic", "lang"]).toArrow().sort_by("doc_id")
    if not got.num_rows:
        return Chain(params)
    toxic = np.asarray(got.column("toxic")) == 1
    lang = np.array(got.column("lang").to_pylist(), dtype=object)
    by = sorted(((-int((toxic & (lang == x)).sum()), x) for x in set(lang) - {None}))
    categories = {f"{TARGET}_{x}": (toxic, lang == x) for n, x in by if -n >= params.min_toxic}
    ids = got.column("ids").combine_chunks()
    size = np.diff(np.asarray(ids.offsets))
    rows = Rows(len(ids), np.repeat(np.arange(len(ids), dtype=np.int32), size), np.asarray(ids.flatten()))
    return train(rows, np.asarray(got.column("key")).view(np.uint64), categories | {TARGET: (toxic, np.ones(len(toxic), dtype=bool))}, params)


def predict(docs: DataFrame, chain: Chain, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``p_toxic`` (the last category), ``categories`` (name
    -> probability) and ``toxic`` (true: rejected)."""

    def run(batches):
        names = [x.name for x in chain.links]
        for b in textio.text_pieces(batches, "_text"):
            prob = predict_texts(chain, textio.texts_of(b, "_text"))
            last = prob[:, -1] if names else np.zeros(len(b))
            cut = pa.array((np.arange(len(b) + 1) * len(names)).astype(np.int32))
            maps = pa.MapArray.from_arrays(cut, pa.array(names * len(b), pa.string()), pa.array(np.ravel(prob)))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(last), maps, pa.array((last >= chain.threshold) & bool(names))],
                names=[*keep, "p_toxic", "categories", "toxic"])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, p_toxic double, categories map<string,double>, toxic boolean")


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain doesn't reject, all columns."""

    def run(batches):
        for b in textio.text_pieces(batches, text_col):
            if chain.links:
                bad = predict_texts(chain, textio.texts_of(b, text_col))[:, -1] >= chain.threshold
                b = b.filter(pa.array(~bad))
            yield b

    return docs.mapInArrow(run, docs.schema)
