"""Tokens of two vocabularies aligned by the bytes they cover (operator 12).

Tokenizer A is a byte-level vocabulary of ``tokenizers``, which reports each
token's characters; tokenizer B a ``sentencepiece`` model, whose proto reports
each piece's span. Both encode the text behind one blank. The spans are coarse
cuts: where a token's span ends before the next one starts, its end is known.
Tokens that share a character (bytes of one character, byte pieces with empty
spans) are told apart by the lengths of their decoded bytes inside the coarse
cut. Ends that both tokenizers share cut the text into groups; two tokens
whose bytes overlap are linked.

Segments (see ``segments``) are encoded once per worker and remembered; the
missing ones of a batch are encoded together, as one text whose borders no
token crosses. Links and groups come from the ends of all tokens of a batch at
once: between two neighbouring ends, of either side, lies exactly one pair of
overlapping tokens. Each text's distinct links are written once; counts per
pair and the scores are joins and sums over that table. The table of pairs is
broadcast up to ``broadcast_pairs`` rows, beyond that the join shuffles, the
pairs spread over ``salts``.

Edge cases: texts that are NULL, empty, or not restored by the tokens of
either side (U+2581, say) have no tokens: zeros and no groups. Special tokens'
strings inside texts are plain text. Repeated rows count each. An empty table
gives none. Columns beyond ``keep`` are ignored; names of ``keep`` that the
result uses are an error.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import segments, textio

# letters and signs of which every version of Unicode says so; the apostrophe belongs to contractions
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Params:
    broadcast_pairs: int = 1_000_000   # rows of two ids, a count and a flag
    salts: int = 32                    # copies of the pair table when the join shuffles
    joined_chars: int = 1 << 17        # of missing segments encoded as one text


def utf8_lengths(cp: np.ndarray) -> np.ndarray:
    return 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)


def byte_ends(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte end of each token. ``begin`` and ``end`` are the library's spans in
    bytes, ``lengths`` the decoded bytes of each token. A span that is not empty
    and ends before the next one starts is a coarse cut; the tokens between two
    coarse cuts end by the lengths of their bytes."""
    after = np.append(begin[1:], end[-1:])
    coarse = (begin < end) & (end <= after)
    fine = np.cumsum(lengths)
    if len(ids) and (fine[coarse] != end[coarse]).any():
        raise ValueError("spans and decoded bytes disagree")
    return np.where(coarse, end, fine)


class Side:
    """One tokenizer: the bytes of its tokens and ids with byte lengths."""

    def __init__(self, words: dict[int, bytes], size: int):
        self.words = [words.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        if size > 1 << 20 or self.lengths.max(initial=0) >= 1 << 11:
            raise ValueError("at most 2^20 ids of less than 2^11 bytes are expected")

    def spans(self, text: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and spans in bytes; ``at`` is the byte at which each character starts."""
        raise NotImplementedError

    def tokens(self, text: str, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and byte ends; None if the tokens don't restore the text."""
        ids, begin, end = self.spans(text, at)
        if b"".join(map(self.words.__getitem__, ids.tolist())) != raw:
            return None
        return ids, byte_ends(ids, begin, end, self.lengths[ids])


class ByteLevel(Side):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]   # bytes that byte-level vocabularies write as themselves
        of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(own))}
        vocab = self.model.get_vocab()
        super().__init__({i: bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t, i in vocab.items()}, max(vocab.values()) + 1)

    def spans(self, text, at):
        found = self.model.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        chars = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids))
        return ids, at[chars[0::2]], at[chars[1::2]]


class Pieces(Side):
    """The model without its leading blank: the texts bring theirs along."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or not spec.normalizer_spec.add_dummy_prefix:
            raise ValueError("a merge-type model that adds a blank is expected")
        spec.normalizer_spec.add_dummy_prefix = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        kinds = spec.SentencePiece
        super().__init__({i: bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE else p.piece.replace("\u2581", " ").encode()
                          for i, p in enumerate(spec.pieces)}, len(spec.pieces))
        self.joins = {p.piece[k:k + 2] for p in spec.pieces for k in range(len(p.piece) - 1)}
        self.separators = segments.safe_separators(p.piece for p in spec.pieces if p.type == kinds.NORMAL)
        # the unit of the proto's spans differs between versions of the library
        self.in_bytes = self.model.encode("\u00e9", return_type="proto").pieces[-1].end == 2

    def spans(self, text, at):
        pieces = list(self.model.encode(text, return_type="proto").pieces)
        ids, begin, end = (np.array(x, dtype=np.int64) for x in ([p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]))
        return (ids, begin, end) if self.in_bytes else (ids, at[begin], at[end])


class Aligner:
    """Segments in, per segment the tokens of both sides as numbers
    (byte length << 20 | id), or None if one side does not restore it."""

    def __init__(self, path_a: str, path_b: str, params: Params = Params()):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
        self.a, self.b, self.params = ByteLevel(path_a), Pieces(path_b), params
        self.pattern = segments.byte_level_pattern(self.b.separators)
        # a word's letters, if a sign follows which no token of either side joins to them
        self.stem = re.compile(f"[{segments.as_class(self.b.separators & set(segments.COMMON_SPACE))}]*[{LETTERS}]+(?=[{SIGNS}])")
        self.leading = self.b.separators & set(segments.COMMON_SPACE)
        # texts without the white space that the full pattern is there for
        self.held = re.compile(f"[{segments.held_space(self.b.separators)}]")
        self.plain = segments.piece_pattern(self.leading) if self.leading else self.pattern
        self._parts: dict[str, tuple[bytes, bytes] | None] = {}

    def cut(self, text: str) -> list[str]:
        return (self.pattern if self.held.search(text) else self.plain).findall(" " + text) if text else []

    def codes(self, segs: list[str]) -> list[tuple[bytes, bytes] | None]:
        parts, joins, stem = self._parts, self.b.joins, self.stem.match
        if len(parts) > segments.MOST_KEPT:
            parts.clear()
        whole, halves = [], []
        for s in segs:
            if (found := stem(s)) and s[(at := found.end()) - 1:at + 1] not in joins:
                halves.append((s, s[:at], s[at:]))
            else:
                whole.append(s)
        missing = list(set(whole).union(*[h[1:] for h in halves]).difference(parts))
        parts.update(zip(missing, self._encoded(missing)))
        out = dict(zip(whole, map(parts.__getitem__, whole)))
        for s, x, y in halves:
            a, b = parts[x], parts[y]
            out[s] = None if a is None or b is None else (a[0] + b[0], a[1] + b[1])
        for p in missing:
            if len(p) > segments.LONGEST_KEPT:
                del parts[p]
        return list(map(out.__getitem__, segs))

    def _encoded(self, segs: list[str]) -> list[tuple[bytes, bytes] | None]:
        out: list = [None] * len(segs)
        group: list[int] = []
        chars = 0
        for k, s in enumerate(segs):
            # what begins with a separator and does not end with one can stand beside others
            if len(s) <= segments.LONGEST_KEPT and s[0] in self.leading and not s[-1].isspace():
                group.append(k)
                chars += len(s)
                if chars > self.params.joined_chars:
                    self._joined(segs, group, out)
                    group, chars = [], 0
            else:
                self._joined(segs, [k], out)
        self._joined(segs, group, out)
        return out

    def _joined(self, segs: list[str], group: list[int], out: list) -> None:
        if not group:
            return
        text = "".join(segs[k] for k in group)
        raw = text.encode("utf-8")
        cp, _ = textio.code_points([text])
        at = np.zeros(len(cp) + 1, dtype=np.int64)
        np.cumsum(utf8_lengths(cp), out=at[1:])
        sides = [side.tokens(text, raw, at) for side in (self.a, self.b)]
        if None in sides:
            if len(group) > 1:                # find the segments that are to blame
                half = len(group) // 2
                self._joined(segs, group[:half], out)
                self._joined(segs, group[half:], out)
            return
        borders = at[np.cumsum([len(segs[k]) for k in group])]
        parts = []
        for ids, ends in sides:
            stop = np.searchsorted(ends, borders)
            if (ends[stop] != borders).any():
                raise ValueError("a token crosses the border of a segment")
            code = (np.diff(ends, prepend=0) << 20 | ids).astype("<i4").tobytes()
            stop = ((stop + 1) * 4).tolist()
            parts.append([code[i:j] for i, j in zip([0, *stop], stop)])
        for k, x, y in zip(group, *parts):
            out[k] = x, y


class Table:
    """Strings of ids with the sign that follows them in ``groups``."""

    def __init__(self, size_a: int, size_b: int):
        self.size_a = size_a
        self.text = [f"{i}{sign}" for n, signs in ((size_a, ",|"), (size_b, ",;")) for i in range(n) for sign in signs]

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
        """All tokens in the order of their places ``at_a`` and ``at_b``."""
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[at_a] = 2 * a + last_a
        code[at_b] = 2 * (self.size_a + b) + last_b
        return list(map(self.text.__getitem__, code.tolist()))


def _ends_of(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(b"".join(codes), dtype="<i4").astype(np.int64)
    return code & 0xFFFFF, np.cumsum(code >> 20)


def align(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          hash_groups: bool = False, params: Params = Params()) -> DataFrame:
    """``keep``, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3`` with
    the ids of A and B in order, or the SHA-256 of it) and links: the distinct
    linked pairs of the text and how often it holds them."""
    names = [*COUNTS, "groups", "links"]
    if clash := set(keep) & {*names, "_row"}:
        raise ValueError(f"{sorted(clash)} are names of the result")

    def run(batches):
        known = segments.of_worker(("align", path_a, path_b, params), lambda: segments.Remembered(Aligner(path_a, path_b, params).codes))
        aligner = known.encode.__self__
        size_a, size_b = len(aligner.a.words), len(aligner.b.words)
        table = Table(size_a, size_b)
        for batch in textio.text_pieces(batches, "_text"):
            texts = textio.texts_of(batch, "_text")
            with segments.without_cycle_search():
                cut = [aligner.cut(t) for t in texts]
                known.learn(cut)
                rows = [list(map(known.__getitem__, x)) for x in cut]
            rows = [[] if None in x else x for x in rows]
            n = len(texts)
            stop = np.cumsum([1 + len(t.encode("utf-8")) if x else 0 for t, x in zip(texts, rows)])
            a, ends_a = _ends_of([c for x in rows for c, _ in x])
            b, ends_b = _ends_of([c for x in rows for _, c in x])
            total = int(stop[-1]) if n else 0
            is_a, is_b = np.zeros(total + 1, dtype=bool), np.zeros(total + 1, dtype=bool)
            is_a[ends_a] = True
            is_b[ends_b] = True
            both = is_a & is_b
            ends = np.flatnonzero(is_a | is_b)
            link_a, link_b = a[np.searchsorted(ends_a, ends)], b[np.searchsorted(ends_b, ends)]
            of = np.searchsorted(stop, ends)
            cuts = np.flatnonzero(both)
            n_groups = np.bincount(np.searchsorted(stop, cuts), minlength=n)
            of_a, of_b = np.searchsorted(stop, ends_a), np.searchsorted(stop, ends_b)
            n_a, n_b, n_links = (np.bincount(x, minlength=n) for x in (of_a, of_b, of))
            # a group's tokens of A stand before its tokens of B
            group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
            before = np.append(0, np.searchsorted(ends_b, cuts, side="right"))         # tokens of B in the groups before
            upto = np.searchsorted(ends_a, cuts, side="right")                         # tokens of A up to the group's end
            words = table.groups(a, b, both[ends_a], both[ends_b], np.arange(len(a)) + before[group_a], np.arange(len(b)) + upto[group_b])
            last = np.cumsum(n_a + n_b).tolist()
            groups = ["".join(words[i:j])[:-1] for i, j in zip([0, *last], last)]
            if hash_groups:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            pairs, times = np.unique((of * size_a + link_a) * size_b + link_b, return_counts=True)
            borders = np.searchsorted(pairs, np.arange(n + 1) * (size_a * size_b)).astype(np.int32)
            links = pa.ListArray.from_arrays(pa.array(borders), pa.StructArray.from_arrays(
                [pa.array((pairs // size_b % size_a).astype(np.int32)), pa.array((pairs % size_b).astype(np.int32)), pa.array(times.astype(np.int32))],
                names=["a", "b", "times"]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)],
                                              pa.array(groups, pa.string()), links], names=[*keep, *names])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a:int,b:int,times:int>>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n, best: how many links of the whole table hold the pair, and
    whether that is the most among the pairs of b."""
    counts = cut_lineage(aligned.select(F.explode("links").alias("_l")).select("_l.*").groupBy("a", "b").agg(F.sum("times").alias("n")))
    most = counts.groupBy("b").agg(F.max("n").alias("_most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best"))


def align_and_score(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                    hash_groups: bool = False, params: Params = Params()) -> DataFrame:
    """``align`` without its links, with n_best (links whose pair is the most
    frequent of its b) and count_sum (the pairs' counts summed over the links)."""
    if clash := {"n_best", "count_sum"} & set(keep):
        raise ValueError(f"{sorted(clash)} are names of the result")
    rows = cut_lineage(align(docs, path_a, path_b, keep, text_col, hash_groups, params).withColumn("_row", F.monotonically_increasing_id()))
    pairs = cut_lineage(pair_counts(rows))
    links = rows.select("_row", F.explode("links").alias("_l")).select("_row", "_l.*")
    on = ["a", "b"]
    if pairs.count() <= params.broadcast_pairs:
        pairs = F.broadcast(pairs)
    else:
        pairs = pairs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1))))
        links = links.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(params.salts)).cast("int"))
        on = [*on, "_salt"]
    sums = links.join(pairs, on).groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
                                                     F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.join(sums, "_row", "left").select(*keep, *COUNTS, "groups", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")])


def digests(scored: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``align_and_score`` with hashed groups, by the names of the contract."""
    return scored.select(*keep, *COUNTS, "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
