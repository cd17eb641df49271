"""Classifiers, vector search, mixing, pipeline, registered queries."""

import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_llm_text import check_places, empty, fp_brute, key, odd, odd_docs  # noqa: F401  (fixtures)

from tillwise.llm import ann, catalog, graph, language_id, mixing, quality_model, textio, toxicity

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
MEDIUM = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.1"


def labels_of(spark, d):
    return {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


# --- shared numpy pieces -------------------------------------------------

def test_hashed_features_follow_each_text_alone():
    texts = ["Hello wörld", "", "a", "Hello", "x1 漢字 \U00020000z hello-hello", " "]
    cp, off = textio.code_points(texts)
    for n in (1, 2, 3):
        ids, s, e = textio.ngram_buckets(cp, off, n, 16)
        for i, t in enumerate(texts):
            alone, s1, e1 = textio.ngram_buckets(*textio.code_points([t]), n, 16)
            assert ids[s[i]:e[i]].tolist() == alone[s1[0]:e1[0]].tolist()
            assert e[i] - s[i] == max(0, len(t) - n + 1)
    starts, h = textio.word_hashes(cp, off, (2, 4))
    import re
    words = [w for t in texts for w in re.findall(r"[^\W_]+", t)]
    assert len(starts) == len(words)
    for a, x in zip(words, range(len(words))):
        for b, y in zip(words, range(len(words))):
            assert (h[0][x] == h[0][y]) == (a == b)
            if len(a) >= 2 and len(b) >= 2:
                assert (h[2][x] == h[2][y]) == (a[:2] == b[:2])
        assert (h[4][x] == 0) == (len(a) < 4)


def test_whole_words_are_hashed():
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh") for _ in range(200))
    words = ["abcdefghijklmnopQQQQ", "abcdefghijklmnopZZZZ", base, base[:-1] + "z", "z" + base[1:], base[:100] + "z" + base[101:], base[:32], base[:33], base[:33] + "z"]
    _, h = textio.word_hashes(*textio.code_points([" ".join(words)]))
    assert len(set(h[0].tolist())) == len(words)
    alone = [int(textio.word_hashes(*textio.code_points([w]))[1][0][0]) for w in words]
    assert h[0].tolist() == alone
    for w in words:      # the polynomial, character by character
        v = 0
        for c in w:
            v = (v * int(textio.BASE) + ord(c) + 1) & 0xFFFFFFFF
        assert (v * int(textio.BASE) + len(w)) & 0xFFFFFFFF == alone[words.index(w)]
    assert textio.word_hashes(*textio.code_points(["a" * 3_000_000]))[1][0].shape == (1,)


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3 if i % 3 else 2).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id % 20 = 0"), ann.Params(leaf_rows=40)).collect()
    hits = 0
    for q in range(0, 900, 20):
        same = [(float(np.linalg.norm(np.array(v) - rows[q][1])), i) for i, v in rows if len(v) == len(rows[q][1]) and i != q]
        want = {i for _, i in sorted(same)[:10]}
        mine = [r for r in got if r.query_id == q]
        assert len(mine) == 10 and all(len(rows[r.vec_id][1]) == len(rows[q][1]) for r in mine)
        hits += len(want & {r.vec_id for r in mine})
    assert hits >= 0.9 * 450


def test_toxicity_of_many_languages_unspaced_scripts_and_text_ids(spark):
    rng = random.Random(6)
    rows = []
    for n, lang in enumerate("abcdefgh"):
        for i in range(60):
            bad = i % 3 == 0
            if lang == "h":     # a script without blanks: the term stands anywhere in a run
                body = "".join(chr(rng.randrange(0x4E00, 0x4E80)) for _ in range(40))
                text = body[:20] + "\u6bd2\u9a82" + body[20:] if bad else body
            else:
                text = " ".join(f"{lang}{rng.randrange(40)}w" for _ in range(20)) + (f" {lang}abcdefghijklmnopBAD" if bad else f" {lang}abcdefghijklmnopGOOD")
            rows.append((f"{lang}-{i}", text, lang, int(bad)))
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, toxic int")
    chain = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    assert len(chain.links) == 9
    got = {r.doc_id: r.toxic for r in toxicity.predict(df, chain).collect()}
    assert sum(got[d] == bool(t) for d, _, _, t in rows) >= 0.97 * len(rows)
    labelled = quality_model.labelled(df, df.select("doc_id", F.col("toxic").alias("quality")), "quality", F.lit(True))
    assert labelled.count() == len(rows)


def test_copies_stand_in_training_order(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 7), f"s{i % 3}") for i in range(200)], "doc_id long, text string, source string").repartition(4)
    mixed = {r.doc_id: r for r in mixing.mix(docs, tie=mixing.row_hash(docs)).collect()}
    p = mixing.Params()

    def place(r, copy):
        x = (copy * r.source_size + r._at + r.copies[copy] / 2) / r._aim
        knots = p.schedules[r.source_no % 3]
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        lo, hi = 0.0, 1.0
        for _ in range(60):      # invert the integral by halving
            t, done = (lo + hi) / 2, 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                u = min(max(t, t0), t1)
                done += (u - t0) * (2 * w0 + (w1 - w0) * (u - t0) / (t1 - t0)) / 2
            lo, hi = (t, hi) if done / area < x else (lo, t)
        return lo

    want = sorted((place(r, c), r.doc_id) for r in mixed.values() for c, w in enumerate(r.copies) if 2 * w >= r.size)
    got = [r.doc_id for r in mixing.take(docs).collect()]
    assert Counter(got) == Counter(d for _, d in want)
    at = {}
    for t, d in want:
        at.setdefault(d, []).append(t)
    seen = Counter()
    order = []
    for d in got:
        order.append(at[d][seen[d]])
        seen[d] += 1
    assert all(b >= a - 1e-9 for a, b in zip(order, order[1:]))


def test_segment_sums():
    v = np.arange(10.0)
    assert textio.segment_sums(v, np.array([0, 3, 3, 7]), np.array([3, 3, 7, 10])).tolist() == [3, 0, 18, 24]
    assert textio.segment_sums(v[:0], np.array([0, 0]), np.array([0, 0])).tolist() == [0, 0]
    assert textio.segment_sums(np.ones((10, 2)), np.array([1, 5]), np.array([4, 5])).tolist() == [[3, 3], [0, 0]]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(7, None), (3, 3)]
    want = {}
    for a, b in edges:
        if b is not None and a != b:
            want.setdefault(a, a)
            want.setdefault(b, b)
    for _ in range(len(edges)):
        for a, b in edges:
            if b is not None and a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- classifiers ---------------------------------------------------------

def test_quality_held_out(spark):
    rows = catalog.QUERIES["op5_subword_quality"](spark, MEDIUM).collect()
    lab = labels_of(spark, MEDIUM)
    held = [(r.score, lab[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in lab]
    s, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    assert len(rows) == 1000 and auc(s, y) > 0.85 and (s[y == 1] >= 0.7).mean() > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_quality_score_is_the_softmax_of_the_mean():
    p = quality_model.Params(bits=8, dim=3, epochs=2)
    texts = ["good words here", "BAD!! BAD!!", "good good here", "BAD!! x"]
    ids, counts = [], []
    for t in texts:
        f = np.concatenate([x[s[0]:e[0]] for x, s, e in quality_model._features([t], p)])
        u, c = np.unique(f, return_counts=True)
        ids.append(u)
        counts.append(c)
    m = quality_model.train(ids, counts, np.array([1, 0, 1, 0]), p)
    together = quality_model.score_texts(m, texts + [""])
    for t, s in zip(texts + [""], together):
        assert quality_model.score_texts(m, [t])[0] == s
    for i in range(4):
        z = (m.logit[ids[i]] * counts[i]).sum() / counts[i].sum() + m.bias
        assert together[i] == pytest.approx(1 / (1 + np.exp(-z)))
    one = quality_model.train(ids, counts, np.array([1, 1, 1, 1]), p)
    assert len(set(quality_model.score_texts(one, texts))) == 1


def test_quality_training_is_stochastic_gradient_descent():
    """The vectorised training against one number at a time, in double precision."""
    p = quality_model.Params(bits=5, dim=2, epochs=3, orders=(2,))
    texts, label = ["ab cd ab", "xx yy", "ab ab", "", "yy zz yy cd"], [1, 0, 1, 0, 0]
    bags = []
    for t in texts:
        f = np.concatenate([x[s[0]:e[0]] for x, s, e in quality_model._features([t], p)])
        bags.append(np.unique(f, return_counts=True))
    m = quality_model.train([b[0] for b in bags], [b[1] for b in bags], np.array(label), p)
    rng = np.random.default_rng(p.seed)
    width = 3 << p.bits          # words, bigrams of characters, pairs of words
    vec = rng.uniform(-1 / p.dim, 1 / p.dim, (width, p.dim)).tolist()
    bias = np.log(2.5 / 3.5)
    layer, offset, step = [[0.0, 0.0] for _ in range(p.dim)], [0.0, bias], 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(texts)):
            rate = p.rate * (1 - step / (p.epochs * len(texts)))
            step += 1
            ids, n = bags[i]
            if not len(ids):
                continue
            hidden = [sum(c * vec[j][d] for j, c in zip(ids, n)) / n.sum() for d in range(p.dim)]
            z = [offset[c] + sum(hidden[d] * layer[d][c] for d in range(p.dim)) for c in (0, 1)]
            err = [np.exp(z[c]) / (np.exp(z[0]) + np.exp(z[1])) - (label[i] == c) for c in (0, 1)]
            back = [sum(layer[d][c] * err[c] for c in (0, 1)) for d in range(p.dim)]
            for d in range(p.dim):
                for c in (0, 1):
                    layer[d][c] -= rate * hidden[d] * err[c]
                for j, c in zip(ids, n):
                    vec[j][d] -= np.sqrt(rate * len(ids)) * c / n.sum() * back[d]
    want = [sum(vec[j][d] * (layer[d][1] - layer[d][0]) for d in range(p.dim)) for j in range(width)]
    assert m.bias == pytest.approx(bias)
    assert np.allclose(m.logit, want, atol=1e-4) and np.abs(m.logit).max() > 1e-3


def test_quality_pairs_stay_inside_a_text():
    p = quality_model.Params(bits=6, orders=())
    texts = ["a b c", "", "d", "e f"]
    f, s, e = list(quality_model._features(texts, p))[1]
    assert (e - s).tolist() == [2, 0, 0, 1]
    for i, t in enumerate(texts):
        g, gs, ge = list(quality_model._features([t], p))[1]
        assert f[s[i]:e[i]].tolist() == g[gs[0]:ge[0]].tolist()


def test_toxicity_recall_and_clean_documents(spark):
    # some labelled documents hold nothing but repeated junk, which no model of the text can tell
    rows = {r.doc_id: r for r in catalog.QUERIES["op6_toxicity_chain"](spark, LARGE).collect()}
    lab = labels_of(spark, LARGE)
    hit = [rows[i].toxic for i, x in lab.items() if x.toxic == 1]
    false = [rows[i].toxic for i, x in lab.items() if x.toxic == 0]
    assert np.mean(hit) > 0.9 and np.mean(false) < 0.005
    assert all(r.categories["toxic"] == r.p_toxic and "toxic_en" in r.categories for r in rows.values())


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    p = toxicity.Params(bits=10, min_ratio=6.0)
    y1 = rng.random(600) < 0.3
    y2 = y1 & (rng.random(600) < 0.9)
    ids = [np.unique(np.concatenate([rng.integers(100, 1000, 8), [1, 2] if a else [3]])) for a in y1]
    everyone = np.ones(600, dtype=bool)
    ids = toxicity.Rows.of(ids, p.bits)
    chain = toxicity.train(ids, np.arange(600), {"first": (y1, everyone), "second": (y2, everyone)}, p)
    assert [x.name for x in chain.links] == ["first", "second"]
    assert len(chain.links[1].earlier) == 1 and chain.links[1].earlier[0] > 0
    assert not toxicity.train(toxicity.Rows.of([], p.bits), np.zeros(0), {}, p).links
    none = toxicity.train(ids, np.arange(600), {"x": (np.zeros(600, dtype=bool), everyone)}, p)
    assert toxicity.predict_texts(none, ["any text", ""]).max() < 0.01


def test_language_held_out_and_undetermined(spark):
    rows = catalog.QUERIES["op10_naive_bayes_language"](spark, MEDIUM).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    held = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(held) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_rare_and_many_languages_are_learned(spark):
    many = [(i, f"{chr(0x4E00 + 2 * i) * 12} {chr(0x4E01 + 2 * i) * 12}", f"l{i:03}") for i in range(300)]
    rows = many + [(7, "the common text", "common")] * 24_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    m = language_id.fit(docs, language_id.Params(orders=(1, 2), bits=12))
    assert m.languages == sorted({x for _, _, x in rows})
    assert np.exp(m.log_prior[m.languages.index("common")]) == pytest.approx(24_000 / 24_300)
    best, _ = language_id.score_texts(m, [t for _, t, _ in many])
    assert np.mean([m.languages[i] == x for i, (_, _, x) in zip(best, many)]) > 0.95


def test_naive_bayes_equals_brute_force(spark):
    p = language_id.Params(orders=(1, 2), bits=8)
    train = [(0, "abab cab", "x"), (1, "zzy yz", "y"), (2, "abba", "x"), (3, "q", None), (4, None, "y")]
    m = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), p)
    assert m.languages == ["x", "y"]
    counts = {"x": Counter(), "y": Counter()}

    def grams(t):
        for ids, s, e in language_id._grams([t], p):
            yield from ids[s[0]:e[0]].tolist()
    for _, t, lang in train:
        if lang:
            counts[lang].update(grams(t or ""))
    width = len(p.orders) << p.bits
    for text in ("abz", "zy", "cab zz"):
        joint = [np.log(0.5) + sum(np.log((counts[x][g] + p.smoothing) / (sum(counts[x].values()) + p.smoothing * width)) for g in grams(text))
                 for x in ("x", "y")]
        best, score = language_id.score_texts(m, [text])
        assert best[0] == int(np.argmax(joint))
        assert score[0] == pytest.approx(1 / (1 + np.exp(min(joint) - max(joint))), rel=1e-4)


def test_classifiers_on_odd_documents(spark, odd, empty):  # noqa: F811
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (6, 1, 0), (6, 0, 0), (9, None, None), (None, 1, 1), (12, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    for docs, lab in ((odd, labels), (empty, labels), (odd, labels.limit(0))):
        n = docs.count()
        q = quality_model.fit(quality_model.labelled(docs, lab, "quality", F.lit(True)))
        assert quality_model.score(docs, q).filter("score BETWEEN 0 AND 1").count() == n
        t = toxicity.fit(docs, lab)
        assert toxicity.predict(docs, t).filter("toxic IS NOT NULL").count() == n
        kept = toxicity.keep_clean(docs, t)
        assert kept.columns == docs.columns and kept.count() <= n
        lang = language_id.predict(docs, language_id.fit(docs.filter("doc_id IS NOT NULL")))
        got = lang.collect()
        assert len(got) == n
        for d, x in {(r.doc_id, r.text) for r in docs.collect()}:
            if not any(c.isalpha() for c in x or ""):
                assert any(r.doc_id == d and r.lang_pred == "und" and r.score == 0 for r in got)


# --- vector search -------------------------------------------------------

def exact(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    at = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in at]


def run_search(spark, rows, params=ann.Params()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(3)
    out = defaultdict(list)
    for r in ann.search(df, df.filter("vec_id % 20 = 0"), params).collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_search_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[1000:2000] = x[1000]                       # a third of all rows are copies
    x[2100:2160] = x[2100]
    ids = np.arange(3000)
    got = run_search(spark, [(int(i), x[i].tolist(), "l") for i in ids], ann.Params(leaf_rows=60, shard_rows=40, block_queries=7))
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    x = x.astype(np.float64)
    for q, found in got.items():
        want = exact(ids, x, q, 10)
        assert [r for r, _, _ in found] == list(range(1, 14))
        for _, v, s in found:
            assert s == np.sqrt(((x[v] - x[q]) ** 2).sum()) and v != q
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len({v for v, _ in want} & {v for _, v, _ in found})
        if 1000 <= q < 2000:
            assert [v for _, v, _ in found] == [v for v, _ in want]
    assert hits / (10 * len(got)) >= 0.9


def test_search_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], "a"), (0, [1.0, 0.0], "a"), (1, [1.0, 0.1], "a"), (2, None, "a"), (3, [0.0, 0.0], "a"), (4, [nan, 1.0], "a"),
            (5, [None, 1.0], "a"), (20, [0.9, 0.0], None), (40, [float("inf"), 0.0], "a"), (None, [1.0, 1.0], "a"), (60, [1.0, 2.0, 3.0], "a")]
    got = run_search(spark, rows)
    assert {q: [v for _, v, _ in f] for q, f in got.items()} == {0: [1, 20], 20: [0, 1]}
    assert run_search(spark, []) == {}


# --- mixing --------------------------------------------------------------

def water(sizes, weights, total, repeat):
    """Targets by resharing the excess, round by round."""
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > repeat * sizes[i] + 1e-9]
        if not over:
            for i in open_:
                target[i] = share[i]
            break
        for i in over:
            target[i] = repeat * sizes[i]
            left -= target[i]
            open_.remove(i)
    return target


def test_mixing_targets_and_counts(spark, odd, empty):  # noqa: F811
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["b", "a", "ä", None, "Z"] + ["hot"] * 8)) for i in range(800)]
    rows += [rows[5]] * 4 + [(None, "no id", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = dict(zip(order, water([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))], sum(sizes.values()), 3)))
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken <= 3 * r.size and (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.5
    again = mixing.mix(docs.repartition(7)).collect()
    assert key((r.doc_id, r.taken, r.position) for r in got) == key((r.doc_id, r.taken, r.position) for r in again)
    copies = Counter(r.doc_id for r in mixing.take(docs).collect())
    want = Counter()
    for r in got:
        want[r.doc_id] += sum(2 * w >= r.size for w in r.copies)
    repeated = rows[5][0]
    assert {k: v for k, v in copies.items() if k != repeated} == {k: v for k, v in want.items() if v and k != repeated}
    assert mixing.take(odd).columns == odd.columns and mixing.mix(odd).count() == odd.count()
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0


def test_mixing_takes_repeated_and_missing_ids_exactly(spark):
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30)))
    rows = [(i, text(), s) for s in "abc" for i in range(150)]                  # the targets: 1 : 2 : 3
    rows += [(None, text(), s) for s in "abc" for _ in range(300)]              # missing ids, different texts
    rows += [(7, "one and the same text", s) for s in "abc" for _ in range(500)]   # equal rows
    rows += [(None, "again the same", "a")] * 900 + [(None, "", "b")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    target = {r.source: r.target for r in got}
    longest = {s: max(len(t.split()) for _, t, x in rows if x == s) for s in "abc"}
    for given in (docs, docs.repartition(3)):
        taken = mixing.take(given).collect()
        words, times = Counter(), Counter((r.source, r.doc_id, r.text) for r in taken)
        for r in taken:
            words[r.source] += len(r.text.split())
        for s in "abc":  # whole rows: off by half of the last one
            assert abs(words[s] - target[s]) <= longest[s] / 2 + 0.5
        size, passes = Counter((s, i, t) for i, t, s in rows), {s: int(round(target[s]) // sum(len(t.split()) for _, t, x in rows if x == s)) for s in "abc"}
        for (s, i, t), n in size.items():
            assert not t and not times[s, i, t] or t and n * passes[s] <= times[s, i, t] <= n * (passes[s] + 1)
        want = Counter()
        for r in got:
            want[r.source, r.doc_id, r.size] += sum(2 * w >= r.size for w in r.copies)
        sized = Counter()
        for (s, i, t), n in times.items():
            sized[s, i, len(t.split())] += n
        assert +sized == +want


def test_positions_invert_the_integral(spark):
    knots = ((0.0, 2.0), (0.25, 1.0), (1.0, 0.5))
    xs = [i / 50 for i in range(51)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", mixing._inverse(F.col("x"), knots).alias("t")).collect()

    def integral(t):
        return sum(np.trapezoid([np.interp(a, *zip(*knots)) for a in (lo, hi)], [lo, hi])
                   for (lo, _), (hi, _) in zip(knots, knots[1:]) for hi in [min(hi, t)] if lo < hi)
    for r in got:
        assert integral(r.t) / integral(1.0) == pytest.approx(r.x, abs=1e-12)


# --- pipeline and queries ------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    lab = labels_of(spark, MEDIUM)
    tox = cp.toxic(spark, docs, MEDIUM)
    tox.write.parquet(str(tmp_path / "a"))
    tox = spark.read.parquet(str(tmp_path / "a"))
    ids = {r.doc_id for r in tox.select("doc_id").collect()}
    assert np.mean([i in ids for i, x in lab.items() if x.toxic == 0]) > 0.99
    assert np.mean([i in ids for i, x in lab.items() if x.toxic == 1]) < 0.35  # few labels to learn from
    near = cp.near_duplicates(spark, tox, MEDIUM)
    kept = {r.doc_id for r in near.collect()}
    rows = tox.collect()
    fps = [fp_brute(r.text) for r in rows]
    from test_llm_text import components_brute
    assert kept == set(components_brute([r.doc_id for r in rows], fps, 4)) and near.columns == docs.columns
    masked = cp.mask_secrets(spark, near, MEDIUM).collect()
    assert len(masked) == len(kept) and all(r.n_chars == len(r.text) for r in masked)
    mixed = cp.mix_sources(spark, near, MEDIUM)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= kept
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3


def test_pipeline_odd_and_empty(spark, odd, empty, tmp_path):  # noqa: F811
    import corpus_pipeline as cp
    for n, given in enumerate((odd, empty)):
        d = tmp_path / f"d{n}"
        given.write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([(3, 0, 1), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        out = cp.run(spark, str(d)).collect()
        check_places(out, 1024)
        assert bool(out) == (n == 0)
    once = cp.near_duplicates(spark, odd, "")
    assert once.columns == odd.columns
    fps = [fp_brute(t) for _, t, *_ in odd_docs()]
    from test_llm_text import components_brute
    assert once.count() == len(set(components_brute(list(range(len(fps))), fps, 4)))


def test_registered_queries_against_sql(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from parity import compare, duck_connection
    con = duck_connection(SMALL)
    names = list(catalog.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    for name, sql in catalog.ORACLE_SQL.items():
        same, what = compare(catalog.QUERIES[name](spark, SMALL), con, sql)
        assert same, f"{name}: {what}"


def test_empty_tables_run_every_query(spark, tmp_path):
    for t in ("documents", "labels", "conversations", "embeddings"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, fn in catalog.QUERIES.items():
        assert fn(spark, str(tmp_path)).count() == (1 if name.startswith("op1_") else 0), name


def test_arrow_batches_are_bounded(spark):
    textio.bounded_batches(spark, 500, 1 << 20)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500
    assert isinstance(pa.array([1]), pa.Array)
