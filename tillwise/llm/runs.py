"""Periodic runs in word sequences by internal pattern matching (operator 13).

A run is a stretch of consecutive words with smallest period q and at least
``max(shortest, repeats * q)`` words that no neighbour extends. Such a run
holds, for 2^k <= q, a dyadic block (2^k words from a multiple of 2^k) whose
next copy starts q words later. So each block asks for its occurrences in the
neighbouring window of starts: its interval in the suffix array is known from
the ranks of prefix doubling, and a wavelet tree over the suffix array answers
range successor queries (the smallest position from x on within the interval).

Occurrences closer than half a block form a progression whose difference is
the block's period p: they all lie in one stretch of period p, and the run's
period is the distance of that stretch from the block's own one, by its end or
by its start. Other occurrences give their distance. The candidates of a block
are therefore few, however many occurrences it has. Each candidate period is
extended to both sides with the ranks (equal ranks are equal words, exactly),
kept if it is long enough, and of one stretch the smallest period stays.

All documents of a piece of a batch share the arrays; ranks start from
(document, word), so nothing matches across documents. Prefix doubling goes on
only with positions whose rank is shared, which in prose are few.

Edge cases: NULL and empty texts have no words and no run. Any text length,
one word over and over included, is taken whole; memory follows the longest
text (about 100 bytes a word). Repeated rows are searched each, an empty table
stays empty, columns beyond ``keep`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textio


@dataclass(frozen=True)
class Params:
    shortest: int = 24    # words of a run at least
    repeats: int = 3      # periods of a run at least

    def __post_init__(self):
        if self.repeats < 3 or self.shortest < 8:
            raise ValueError("runs have three periods and eight words at least")

    @property
    def first_level(self) -> int:
        """The smallest blocks: three of them fit into the shortest run."""
        return max(0, (self.shortest // 3).bit_length() - 1)


class Ranks:
    """Ranks of all words by their first 2^k words, k = 0, 1, ..: the number of
    suffixes that are smaller, the same for equal ones."""

    def __init__(self, symbols: np.ndarray, doc: np.ndarray, length: np.ndarray, longest_block: int):
        n = len(symbols)
        self.n = n
        self.ends = np.cumsum(length)[doc] if n else np.zeros(0, dtype=np.int64)   # past the last word of a word's document
        key = doc.astype(np.int64) << 32 | symbols
        self.sa = np.argsort(key, kind="stable")
        ordered = key[self.sa]
        self.levels = [self._settled(np.arange(n), self.sa, ordered, np.empty(n, dtype=np.int64))]
        k = 0
        while 2 << k <= longest_block:
            rank = self.levels[-1]
            shared = self._shared(rank)
            new = rank.copy()
            if len(shared):
                at = self.sa[shared]                             # in order of rank
                second = at + (1 << k)
                inside = second < self.ends[at]
                # a suffix that ends here is smaller than the others and like none of them
                tail = np.where(inside, rank[np.minimum(second, n - 1)] + 1, 0)
                order = np.lexsort((at, tail, rank[at]))
                at = at[order]
                self.sa[shared] = at
                head, tail = rank[at], tail[order]
                alone = tail == 0
                fresh = np.ones(len(at), dtype=bool)
                fresh[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]) | alone[1:]
                new[at] = shared[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            self.levels.append(new)
            k += 1

    @staticmethod
    def _settled(places: np.ndarray, at: np.ndarray, ordered: np.ndarray, out: np.ndarray) -> np.ndarray:
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        out[at] = places[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(at) else 0
        return out

    def sizes(self, rank: np.ndarray) -> np.ndarray:
        return np.bincount(rank, minlength=self.n)

    def _shared(self, rank: np.ndarray) -> np.ndarray:
        """Places in the suffix array whose rank is held by several."""
        return np.flatnonzero((self.sizes(rank) > 1)[rank[self.sa]])

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of the suffixes i < j."""
        out = np.zeros(len(i), dtype=np.int64)
        end = self.ends[i]
        live = np.ones(len(i), dtype=bool)
        top = len(self.levels) - 1
        while live.any():                                        # whole blocks of the top level, then smaller ones
            live = self._step(self.levels[top], 1 << top, i, j, end, out, live)
        for k in range(top - 1, -1, -1):
            self._step(self.levels[k], 1 << k, i, j, end, out, np.ones(len(i), dtype=bool))
        return out

    def _step(self, rank, size, i, j, end, out, live):
        at = np.flatnonzero(live & (j + out + size <= end))
        same = at[rank[i[at] + out[at]] == rank[j[at] + out[at]]]
        out[same] += size
        more = np.zeros(len(i), dtype=bool)
        more[same] = True
        return more

    def backward(self, i: np.ndarray, j: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Length of the longest common ending of the words before i < j."""
        out = np.zeros(len(i), dtype=np.int64)
        live = np.ones(len(i), dtype=bool)
        top = len(self.levels) - 1
        while live.any():
            live = self._back(self.levels[top], 1 << top, i, j, start, out, live)
        for k in range(top - 1, -1, -1):
            self._back(self.levels[k], 1 << k, i, j, start, out, np.ones(len(i), dtype=bool))
        return out

    def _back(self, rank, size, i, j, start, out, live):
        at = np.flatnonzero(live & (i - out - size >= start))
        same = at[rank[i[at] - out[at] - size] == rank[j[at] - out[at] - size]]
        out[same] += size
        more = np.zeros(len(i), dtype=bool)
        more[same] = True
        return more


class WaveletTree:
    """Range successor over an array of numbers, level by level from the
    highest bit; each level holds the zeros before the ones."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros_before: list[np.ndarray] = []
        self.zeros: list[int] = []
        v = values
        for b in range(self.bits - 1, -1, -1):
            one = (v >> b & 1).astype(bool)
            count = np.zeros(len(v) + 1, dtype=np.int32)
            np.cumsum(~one, out=count[1:])
            self.zeros_before.append(count)
            self.zeros.append(int(count[-1]))
            v = np.concatenate([v[~one], v[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values in lo..hi are smaller than x."""
        big = x >> self.bits > 0
        out = np.where(big, hi - lo, 0)
        lo, hi = lo.copy(), hi.copy()
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            count, z = self.zeros_before[level], self.zeros[level]
            l0, h0 = count[lo], count[hi]
            one = (x >> b & 1).astype(bool)
            out += np.where(one & ~big, h0 - l0, 0)
            lo = np.where(one, z + lo - l0, l0)
            hi = np.where(one, z + hi - h0, h0)
        return out

    def nth(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value number ``nth`` of lo..hi in order; -1 if there is none."""
        none = nth >= hi - lo
        nth, lo, hi = np.where(none, 0, nth), lo.copy(), hi.copy()
        out = np.zeros(len(lo), dtype=np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            count, z = self.zeros_before[level], self.zeros[level]
            l0, h0 = count[lo], count[hi]
            one = nth >= h0 - l0
            nth = np.where(one, nth - (h0 - l0), nth)
            out |= one.astype(np.int64) << b
            lo = np.where(one, z + lo - l0, l0)
            hi = np.where(one, z + hi - h0, h0)
            hi = np.where(none, lo, hi)
        return np.where(none, -1, out)

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value from x on in lo..hi, or -1."""
        return self.nth(lo, hi, self.below(lo, hi, x))


def find_runs(symbols: np.ndarray, length: np.ndarray, params: Params = Params()) -> np.ndarray:
    """All runs of documents laid end to end: rows (document, start, length,
    period) by document, start and period; ``start`` counts in the document."""
    doc = np.repeat(np.arange(len(length)), length)
    first = np.cumsum(length) - length
    none = np.zeros((0, 4), dtype=np.int64)
    longest_period = int(length.max(initial=0)) // params.repeats
    k0 = params.first_level
    if int(length.max(initial=0)) < params.shortest:
        return none
    ranks = Ranks(symbols, doc, length, max(1 << k0, longest_period))
    top = len(ranks.levels) - 1
    if k0 > top:
        return none
    # only positions whose block of the first level occurs again in the document can matter
    size0 = ranks.sizes(ranks.levels[k0])
    kept = (size0 > 1)[ranks.levels[k0][ranks.sa]]
    if not kept.any():
        return none
    place = np.zeros(ranks.n + 1, dtype=np.int64)
    np.cumsum(kept, out=place[1:])
    at = ranks.sa[kept]
    tree = WaveletTree(at - first[doc[at]])
    found = []
    for k in range(k0, top + 1):
        m = 1 << k
        rank = ranks.levels[k]
        starts = first[doc]
        size = ranks.sizes(rank)
        local = np.arange(ranks.n) - starts
        block = np.flatnonzero((local % m == 0) & (size[rank] > 1) & (np.arange(ranks.n) + m <= ranks.ends))
        if len(block):
            lo = place[rank[block]]
            hi = place[rank[block] + size[rank[block]]]
            found.append(_candidates(ranks, tree, block, lo, hi, starts, m, 1 if k == k0 else m))
    i = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    d = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
    if not len(i):
        return none
    i, d = np.unique(np.stack([i, d], axis=1), axis=0).T
    start = first[doc[i]]
    end = i + d + ranks.forward(i, i + d)
    begin = i - ranks.backward(i, i + d, start)
    long = end - begin >= np.maximum(params.shortest, params.repeats * d)
    begin, end, d = begin[long], end[long], d[long]
    order = np.lexsort((d, end, begin))
    begin, end, d = begin[order], end[order], d[order]
    smallest = np.ones(len(d), dtype=bool)
    smallest[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, d = begin[smallest], end[smallest], d[smallest]
    rows = np.stack([doc[begin], begin - first[doc[begin]], end - begin, d], axis=1) if len(d) else none
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _candidates(ranks: Ranks, tree: WaveletTree, block, lo, hi, starts, m: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) pairs worth a look: distances from ``nearest`` to
    2 m - 1 that follow from the block's occurrences."""
    out_i, out_d = [], []
    base = starts[block]
    x = block - base + nearest
    last = block - base + 2 * m - 1
    while len(block):
        o = tree.successor(lo, hi, x)
        ok = (o >= 0) & (o <= last)
        block, lo, hi, base, last, o = (v[ok] for v in (block, lo, hi, base, last, o))
        if not len(block):
            break
        o += base
        own = (o - block) * 2 <= m                                # the block's own stretch goes on
        nxt = tree.successor(lo, hi, o - base + 1)
        period = np.where(own, o - block, np.where((nxt >= 0) & (nxt <= last), nxt + base - o, m))
        close = own | (period * 2 <= m)
        plain = own | ~close
        out_i.append(block[plain])
        out_d.append((o - block)[plain])
        x = o - base + 1
        if close.any():
            c = np.flatnonzero(close)
            p, b, occ = period[c], block[c], o[c]
            e2 = occ + p + ranks.forward(occ, occ + p)
            other = np.flatnonzero(~own[c])
            if len(other):
                b, occ, p = b[other], occ[other], p[other]
                e1 = b + p + ranks.forward(b, np.minimum(b + p, ranks.ends[b] - 1))
                s = starts[b]
                b1, b2 = b - ranks.backward(b, b + p, s), occ - ranks.backward(occ, occ + p, s)
                for d in (e2[other] - e1, b2 - b1):
                    good = (d > 0) & (b + d < ranks.ends[b])
                    out_i.append(b[good])
                    out_d.append(d[good])
            x[c] = np.maximum(x[c], e2 - m + 1 - base[c])         # the last occurrence of this stretch starts at e2 - m
    return (np.concatenate(out_i), np.concatenate(out_d)) if out_i else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def words_of(text: str) -> list[bytes]:
    """Words are stretches without blanks and U+0009 to U+000D."""
    return text.encode("utf-8", "surrogatepass").split()


def runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", params: Params = Params()) -> DataFrame:
    """``keep``, n_words, runs (start, length, period in words, by start and
    period) and collapsed: the text's words joined by a blank, without those
    that a run holds after its first period."""
    names = ["n_words", "runs", "collapsed"]
    if clash := set(keep) & set(names):
        raise ValueError(f"{sorted(clash)} are names of the result")

    def run(batches):
        for b in textio.text_pieces(batches, "_text", 4 << 20):
            words = [words_of(t) for t in textio.texts_of(b, "_text")]
            length = np.array([len(w) for w in words], dtype=np.int64)
            number: dict[bytes, int] = {}
            symbols = np.array([number.setdefault(w, len(number)) for x in words for w in x], dtype=np.int64)
            found = find_runs(symbols, length, params)
            borders = np.searchsorted(found[:, 0], np.arange(len(words) + 1))
            collapsed = []
            for k, (i, j) in enumerate(zip(borders, borders[1:])):
                if i < j:
                    gone = np.zeros(length[k] + 1, dtype=np.int64)
                    np.add.at(gone, found[i:j, 1] + found[i:j, 3], 1)
                    np.add.at(gone, found[i:j, 1] + found[i:j, 2], -1)
                    words[k] = [w for w, g in zip(words[k], np.cumsum(gone).tolist()) if not g]
                collapsed.append(b" ".join(words[k]).decode("utf-8", "surrogatepass"))
            of = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(length), pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), of),
                                              pa.array(collapsed, pa.string())], names=[*keep, *names])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Planted periods: where h = crc32 of the id is divisible by 10, with
    g = h div 10 and n words, the words from a = g mod n on repeat the p =
    1 + (n - a) div (3 + g mod 8) words that stand there. Other texts, those
    without an id or without words among them, stay as they are."""
    taken = {c.lower() for c in docs.columns}
    name = {k: next(f"_{k}{i}" for i in range(len(taken) + 1) if f"_{k}{i}" not in taken) for k in ("h", "w", "n", "a", "p")}
    h, w, n, start, p = (F.col(name[k]) for k in ("h", "w", "n", "a", "p"))
    g = f"{name['h']} div 10"
    planted = F.when((F.pmod(h, F.lit(10)) == 0) & F.col(text_col).isNotNull(), F.filter(F.split(text_col, "[\\x20\\x09-\\x0D]+"), lambda x: x != ""))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - start - 1), lambda k: F.element_at(w, (start + F.pmod(k, p) + 1).cast("int")))
    text = F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), start.cast("int")), tail), " ")).otherwise(F.col(text_col))
    return (docs.withColumn(name["h"], F.crc32(F.col(id_col).cast("string").cast("binary"))).withColumn(name["w"], planted)
                .withColumn(name["n"], F.coalesce(F.size(w), F.lit(0)).cast("long"))
                .withColumn(name["a"], F.when(n > 0, F.expr(f"({g}) % {name['n']}")))
                .withColumn(name["p"], F.expr(f"1 + ({name['n']} - {name['a']}) div (3 + ({g}) % 8)"))
                .select(*[text.alias(c) if c == text_col else c for c in docs.columns]))


def digests(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of runs, the run of the greatest length / period (ties: smallest
    start, then period) and hashes of all runs and of the collapsed text."""
    # a / b < c / d exactly if a d < c b; the greatest by folding over the runs
    ahead = "r.length * b.period > b.length * r.period OR (r.length * b.period = b.length * r.period AND (r.start, r.period) < (b.start, b.period))"
    best = F.expr(f"aggregate(runs, runs[0], (b, r) -> CASE WHEN {ahead} THEN r ELSE b END)")
    best = F.when(F.size("runs") > 0, best)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    return (found.withColumn("_best", best)
                 .select(*keep, F.size("runs").cast("long").alias("n_runs"), *[F.col("_best")[c].alias(c) for c in ("start", "length", "period")],
                         F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
