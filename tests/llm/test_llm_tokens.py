"""SentencePiece encoding by backtracking, tokenizer spans, periodic runs: each
against the libraries or a brute force version."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from test_llm_text import DOCS, empty, key, odd  # noqa: F401  (fixtures)

from tillwise.llm import align, catalog, merges, runs, segments

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ALPHABET = "ab erint(){};\r\n\t\x0b\x0c   é漢🙂'\"/*0\x1c　\xa0.,_-²ß\x00"
LONG = ["a" * 400_000, " " * 400_001, "\n" * 300_000, "the cat " * 60_000, "ab" * 200_000, "🙂" * 100_000, "ing\r\r" * 60_000]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return merges.MergeEncoder(PIECES)


def encoded(encoder, text):
    return [int(x) for s in encoder.cut(text) for x in np.frombuffer(encoder.code(s), dtype="<i4")]


# --- operator 11 ---------------------------------------------------------

@given(st.text(alphabet=st.sampled_from(ALPHABET + "▁"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_backtracking_equals_the_library(encoder, sp, text):
    assert encoded(encoder, text) == sp.encode(text)


@given(st.text(max_size=30))
@settings(max_examples=200, deadline=None)
def test_any_characters(encoder, sp, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoded(encoder, text) == sp.encode(text)


def test_every_piece_and_pair_of_pieces(encoder, sp):
    rng = random.Random(2)
    pieces = list(encoder.id)
    for p in pieces:
        assert encoded(encoder, p) == sp.encode(p)
    for _ in range(5000):
        t = "".join(rng.choices(pieces, k=rng.randrange(2, 5)))
        assert encoded(encoder, t) == sp.encode(t)


@pytest.mark.parametrize("text", LONG, ids=lambda t: repr(t[:4]))
def test_long_texts_whole(encoder, sp, text):
    assert encoded(encoder, text) == sp.encode(text)


def test_a_backtracking_step_marks_failed_positions():
    """A vocabulary on which the longest piece is wrong and has to be given up."""
    e = merges.MergeEncoder.__new__(merges.MergeEncoder)
    import ahocorasick
    pieces = ["bc", "ab", "abc", "cd", "bcd", "a", "b", "c", "d", "abcx"]      # best first
    e.text = dict(enumerate(pieces))
    e.id = {p: i for i, p in e.text.items()}
    e.score = {p: -i for i, p in e.text.items()}
    e.size = {i: len(p) for i, p in e.text.items()}
    e.automaton = ahocorasick.Automaton()
    for i, p in e.text.items():
        e.automaton.add_word(p, (i, len(p) - 1))
    e.automaton.make_automaton()
    e._shorter, e._steps, e._apart = {}, {}, {}

    def merged(s):
        parts = list(s)
        while True:
            best = max(((e.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in e.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    rng = random.Random(1)
    for _ in range(3000):
        s = "".join(rng.choice("abcdx") for _ in range(rng.randrange(1, 14)))
        assert [e.string(t) for t in e.tokens(s)] == merged(s)


def test_op11_odd_rows(odd, empty, sp):
    out = merges.digests(merges.encode(odd, PIECES, end_id=2), PIECES).collect()
    want = []
    for r in odd.collect():
        ids = sp.encode(r.text or "") + [2]
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert key(tuple(r) for r in out) == key(want)
    assert merges.digests(merges.encode(empty, PIECES), PIECES).count() == 0
    kept = merges.encode(odd, PIECES, keep=("doc_id", "ids", "length"), ids_col="tokens")
    assert kept.columns == ["doc_id", "ids", "length", "tokens"]
    with pytest.raises(ValueError):
        merges.encode(odd, PIECES, keep=("ids",))


def test_op11_without_end_id_and_decoded(spark, sp):
    texts = ["a  b", "", None, "naïve 🙂", "x\ny"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    enc = merges.encode(df, PIECES)
    assert {r.doc_id: r.ids for r in enc.collect()} == {i: sp.encode(t or "") for i, t in enumerate(texts)}
    assert {r.doc_id: r.decoded for r in merges.decode(enc, PIECES).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_op11_query(spark, sp):
    rows = catalog.QUERIES["op11_merge_backtracking"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {r.doc_id: " ".join(map(str, sp.encode(r.text or "") + [2])) for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest() and r.n_tokens == want[r.doc_id].count(" ") + 1


def test_memory_of_segments_is_bounded(monkeypatch):
    calls = []
    known = segments.Remembered(lambda x: calls.append(len(x)) or [s.upper() for s in x])
    monkeypatch.setattr(segments, "MOST_KEPT", 3)
    long = "y" * 100
    assert known.learn([["a", "b"], ["a", long]])[long] == long.upper()
    known.learn([["c", "d"]])
    assert long not in known and known["c"] == "C"
    known.learn([["e"]])
    assert "a" not in known and known["e"] == "E" and calls == [3, 2, 1]


# --- operator 12 ---------------------------------------------------------

def brute_alignment(text, tok, sp):
    """(ids A, ids B, linked pairs, groups) by comparing all byte ranges."""
    if not text:
        return None
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(own))}
    left, ids_b = tok.encode(" " + text, add_special_tokens=False), sp.encode(text)
    words_a = [bytes(of[c] for c in t) for t in left.tokens]
    names = [sp.id_to_piece(i) for i in ids_b]
    words_b = [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, names)]
    raw = (" " + text).encode()
    if b"".join(words_a) != raw or b"".join(words_b) != raw:
        return None
    ends_a, ends_b = (np.cumsum([len(w) for w in x]).tolist() for x in (words_a, words_b))
    a = list(zip(left.ids, [0, *ends_a], ends_a))
    b = list(zip(ids_b, [0, *ends_b], ends_b))
    links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    groups, at = [], 0
    for c in sorted(set(ends_a) & set(ends_b)):
        groups.append(",".join(str(i) for i, _, e in a if at < e <= c) + "|" + ",".join(str(j) for j, _, f in b if at < f <= c))
        at = c
    return left.ids, ids_b, links, ";".join(groups)


def brute_scores(texts, tok, sp):
    found = [brute_alignment(t, tok, sp) for t in texts]
    counts = Counter(x for f in found if f for x in f[2])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (len(f[0]), len(f[1]), f[3].count(";") + 1, len(f[2]), sum(counts[x] == most[x[1]] for x in f[2]), sum(counts[x] for x in f[2]), f[3])
            for f in found]


def hard_texts():
    rng = random.Random(9)
    drawn = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    return [None, "", " ", "\n", "a▁b", "hello wörld 漢字🙂<|endoftext|></s> x<0x41>", "  a \r\n b  ", "é" * 900, "hello wörld", "hello wörld", *drawn]


@pytest.mark.parametrize("params", [align.Params(), align.Params(broadcast_pairs=0, salts=3, joined_chars=50)])
def test_alignment_equals_brute_force(spark, tok, sp, params):
    texts = hard_texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, links string, a int").repartition(3)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
           for r in align.align_and_score(df, BYTES, PIECES, params=params).collect()}
    assert got == dict(enumerate(brute_scores(texts, tok, sp)))


@given(st.lists(st.text(alphabet=st.sampled_from(ALPHABET + "don't"), min_size=1, max_size=25), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_segments_hold_the_tokens_of_the_text(tok, sp, texts):
    aligner = test_segments_hold_the_tokens_of_the_text.__dict__.setdefault("aligner", align.Aligner(BYTES, PIECES))
    known = segments.Remembered(aligner.codes)
    cut = [aligner.cut(t) for t in texts]
    known.learn(cut)
    for t, x in zip(texts, cut):
        assert "".join(x) == " " + t
        for side, want in ((0, tok.encode(" " + t, add_special_tokens=False).ids), (1, sp.encode(t))):
            assert (np.frombuffer(b"".join(known[s][side] for s in x), dtype="<i4") & 0xFFFFF).tolist() == want


def test_spans_refined_by_bytes():
    """Three tokens share one character of four bytes, as both libraries report it."""
    for begin, end in (([0, 1, 1, 1, 5], [1, 5, 5, 5, 6]), ([0, 1, 1, 1, 5], [1, 1, 1, 5, 6])):
        ends = align.byte_ends(np.arange(5), np.array(begin), np.array(end), np.array([1, 2, 1, 1, 1]))
        assert ends.tolist() == [1, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        align.byte_ends(np.arange(2), np.array([0, 1]), np.array([1, 2]), np.array([2, 1]))


@pytest.mark.parametrize("text", LONG, ids=lambda t: repr(t[:4]))
def test_long_texts_aligned_whole(spark, tok, sp, text):
    r = align.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), BYTES, PIECES).collect()[0]
    assert (r.n_a, r.n_b) == (len(tok.encode(" " + text, add_special_tokens=False).ids), len(sp.encode(text)))
    assert sum(x.times for x in r.links) == r.n_links


def test_op12_odd_rows(odd, empty, tok, sp):
    rows = odd.collect()
    want = brute_scores([r.text and r.text[:3000] for r in rows], tok, sp)
    short = odd.withColumn("text", odd.text.substr(1, 3000))
    got = align.digests(align.align_and_score(short, BYTES, PIECES, hash_groups=True)).collect()
    hashed = [(r.doc_id, *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for r, w in zip(rows, want)]
    assert key(tuple(r) for r in got) == key(hashed)
    assert align.align_and_score(empty, BYTES, PIECES).count() == 0
    with pytest.raises(ValueError):
        align.align(odd, BYTES, PIECES, keep=("doc_id", "links"))


# --- operator 13 ---------------------------------------------------------

def brute_runs(w, shortest=24, repeats=3):
    out = {}
    for q in range(1, len(w) // repeats + 1):
        same = [a == b for a, b in zip(w, w[q:])] + [False]
        start = None
        for j, ok in enumerate(same):
            if ok and start is None:
                start = j
            elif not ok and start is not None:
                if j - start + q >= max(shortest, repeats * q):
                    out.setdefault((start, j - start + q), q)
                start = None
    return sorted((s, n, q) for (s, n), q in out.items())


def repetitive(rng):
    n, w = rng.randrange(0, 260), []
    if rng.random() < 0.2:
        return [rng.randrange(rng.randrange(1, 3)) for _ in range(n)]
    while len(w) < n:
        kind = rng.randrange(4)
        if kind == 0:
            w += [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
        elif kind == 1:
            p = [rng.randrange(2) for _ in range(rng.randrange(1, 30))]
            w += p * rng.randrange(1, 7) + p[:rng.randrange(len(p) + 1)]
        elif kind == 2:
            w += ([rng.randrange(2) for _ in range(rng.randrange(1, 4))] * rng.randrange(1, 9) + [rng.randrange(3)]) * rng.randrange(1, 6)
        else:
            w += [rng.randrange(2)] * rng.randrange(1, 40)
    return w[:n]


@pytest.mark.parametrize("params", [runs.Params(), runs.Params(shortest=12), runs.Params(shortest=50, repeats=4)])
def test_runs_equal_brute_force(params):
    rng, total = random.Random(params.shortest), 0
    for _ in range(250):
        docs = [repetitive(rng) for _ in range(rng.randrange(1, 6))]
        got = runs.find_runs(np.array([x for d in docs for x in d], dtype=np.int64), np.array([len(d) for d in docs]), params)
        want = [(i, *r) for i, d in enumerate(docs) for r in brute_runs(d, params.shortest, params.repeats)]
        assert [tuple(r) for r in got.tolist()] == want
        total += len(want)
    assert total > 200


@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.data())
@settings(max_examples=100, deadline=None)
def test_range_successor(values, data):
    tree = runs.WaveletTree(np.array(values))
    lo = data.draw(st.integers(0, len(values)))
    hi = data.draw(st.integers(lo, len(values)))
    x = data.draw(st.integers(0, 90))
    want = min((v for v in values[lo:hi] if v >= x), default=-1)
    assert tree.successor(np.array([lo]), np.array([hi]), np.array([x])).tolist() == [want]


def test_long_runs():
    for w, want in (([0] * 300_000, [[0, 0, 300_000, 1]]), ([0, 1] * 100_000, [[0, 0, 200_000, 2]]), (list(range(1000)) * 300, [[0, 0, 300_000, 1000]])):
        assert runs.find_runs(np.array(w), np.array([len(w)])).tolist() == want


def brute_row(doc_id, text, planted):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_op13_query(spark):
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len(r.text or "") < 12_000]
    df = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string").repartition(3)
    got = runs.digests(runs.runs(runs.with_repeated_tails(df))).collect()
    assert key(tuple(r) for r in got) == key(brute_row(r.doc_id, r.text, True) for r in docs)
    assert sum(r.n_runs > 0 for r in got) > 10
    whole = catalog.QUERIES["op13_periodic_runs"](spark, SMALL)
    assert whole.columns == got[0].__fields__ and whole.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_op13_odd_rows(spark, odd, empty):
    rows = odd.collect()
    got = runs.digests(runs.runs(odd)).collect()
    assert len(got) == len(rows)
    short = odd.withColumn("text", odd.text.substr(1, 4000))
    planted = runs.digests(runs.runs(runs.with_repeated_tails(short))).collect()
    assert key(tuple(r) for r in planted) == key(brute_row(r.doc_id, r.text and r.text[:4000], True) for r in rows)
    assert runs.digests(runs.runs(runs.with_repeated_tails(empty))).count() == 0
    assert runs.with_repeated_tails(odd).columns == odd.columns
    clash = spark.createDataFrame([(20, "a b c d e f g h i j k l", 1, 2)], "doc_id long, text string, _n0 int, _a0 int")
    assert runs.with_repeated_tails(clash).columns == clash.columns and runs.with_repeated_tails(clash).count() == 1
    with pytest.raises(ValueError):
        runs.runs(odd.withColumnRenamed("fp", "runs"), keep=("doc_id", "runs"))


def test_plain_cuts_and_no_cycle_search():
    """Texts without rare white space are cut by the simpler pattern, at the
    same places; the search for cycles is back on behind a batch."""
    import gc
    import random

    import public_tokenizers
    from tillwise.llm import align, segments

    aligner = align.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    plain = 0
    for _ in range(3000):
        text = "".join(rng.choices(" \t\n\rab1,\u00e9\u3000\u2028", [6, 2, 2, 2, 5, 5, 2, 2, 2, .3, .3], k=rng.randint(1, 40)))
        plain += not aligner.held.search(text)
        assert aligner.cut(text) == aligner.pattern.findall(" " + text)
    assert 500 < plain < 2900
    words = [" word", " word,", " word;x", ",", "\u2581", " a\u2581,", " " + "long" * 40 + "!", " word,"]
    assert aligner.codes(words) == [aligner.codes([w])[0] for w in words]
    with segments.without_cycle_search():
        assert not gc.isenabled()
    assert gc.isenabled()
