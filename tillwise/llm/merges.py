"""SentencePiece encoding and decoding by backtracking (operator 11).

The vocabulary is of the merge type: neighbouring symbols whose joint string
is a piece merge, best score first, leftmost of equals, until none is left.
``MergeEncoder`` finds the same tokens without running the merges over the
text. An Aho-Corasick automaton over the pieces gives the longest piece that
starts at each character. A sequence of tokens is the result of the merges
exactly if each pair of neighbours is: merging never looks beyond the symbols
it joins, so the first merge across a border would also happen in the string
of the two tokens alone. Whether two tokens stay apart is found by merging
their strings again, each on its own in its fixed order, and looking for a
better merge across the border. The search takes the longest piece, falls back
on shorter pieces that begin like it, and steps back if none fits; positions
from which no token led on are marked in a bitfield and never tried again.

Texts are cut at places where no piece crosses (see ``segments``).

Edge cases: a NULL or empty text has no tokens but the end id. Characters
without a piece become byte pieces. U+2581 in a text is a blank, as in the
library. Repeated rows are encoded each, an empty table stays empty, columns
beyond ``keep`` are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import segments, textio

SPACE = "▁"


class MergeEncoder:
    """Ids of a sentencepiece model of the merge type with byte pieces."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, kinds = spec.normalizer_spec, spec.SentencePiece
        if (spec.trainer_spec.model_type != spec.trainer_spec.BPE or not spec.trainer_spec.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)):
            raise ValueError("a merge-type model with byte pieces, no normalisation and no user symbols is expected")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.text = {i: p.piece for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        self.id = {p: i for i, p in self.text.items()}
        self.score = {p.piece: p.score for p in spec.pieces if p.type == kinds.NORMAL}
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == kinds.BYTE}
        self.size = {i: len(p) for i, p in self.text.items()}
        self.automaton = ahocorasick.Automaton()
        for i, p in self.text.items():
            self.automaton.add_word(p, (i, len(p) - 1))
        self.automaton.make_automaton()
        self.pattern = segments.piece_pattern(segments.safe_separators(self.id))
        self.joins = {p[k:k + 2] for p in self.id for k in range(len(p) - 1)}
        self._parts: dict[str, bytes] = {}
        self._shorter: dict[int, int | None] = {}
        self._steps: dict[int, tuple | None] = {}
        self._apart: dict[tuple[int, int], bool] = {}

    def lone(self, char: str) -> int:
        """The token of one character: its piece, or a negative number."""
        return self.id.get(char, -1 - ord(char))

    def string(self, token: int) -> str:
        return self.text[token] if token >= 0 else chr(-1 - token)

    def shorter(self, token: int) -> int | None:
        """The longest token that is a true beginning of ``token``."""
        if token not in self._shorter:
            s = self.string(token)
            known = (self.id[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.id)
            self._shorter[token] = None if len(s) == 1 else next(known, self.lone(s[0]))
        return self._shorter[token]

    def steps(self, token: int) -> tuple | None:
        """The merges that build ``token``: scores, and its first and last
        symbol before each of them and at the end. None if merging its
        characters does not give it."""
        if token not in self._steps:
            parts, score = list(self.string(token)), self.score
            scores, first, last = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = None, -1
                for k in range(len(parts) - 1):
                    v = score.get(parts[k] + parts[k + 1])
                    if v is not None and (best is None or v > best):
                        best, at = v, k
                if at < 0:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                scores.append(best)
                first.append(parts[0])
                last.append(parts[-1])
            self._steps[token] = (scores, first, last) if len(parts) == 1 else None
        return self._steps[token]

    def apart(self, left: int, right: int) -> bool:
        """True if merging the string of both tokens gives these two."""
        key = left, right
        found = self._apart.get(key)
        if found is None:
            a, b = self.steps(left), self.steps(right)
            found = a is not None and b is not None and self._stay_apart(a, b)
            if len(self._apart) > 1 << 20:
                self._apart.clear()
            self._apart[key] = found
        return found

    def _stay_apart(self, a: tuple, b: tuple) -> bool:
        (left, _, ends), (right, starts, _) = a, b
        i = j = 0
        while True:
            across = self.score.get(ends[i] + starts[j])
            if i == len(left):
                if j == len(right):
                    return across is None
                if across is not None and across >= right[j]:   # the border stands left of the merge
                    return False
                j += 1
            elif j == len(right) or left[i] >= right[j]:
                if across is not None and across > left[i]:     # the merge stands left of the border
                    return False
                i += 1
            else:
                if across is not None and across >= right[j]:
                    return False
                j += 1

    def tokens(self, s: str) -> list[int]:
        """Tokens of one segment (blanks already replaced)."""
        n = len(s)
        longest: list[int | None] = [None] * n
        for end, (t, more) in self.automaton.iter(s):      # at a start, later matches are longer
            longest[end - more] = t
        failed: bytearray | None = None
        apart, shorter, size = self._apart, self._shorter, self.size
        out: list[int] = []
        pos = 0
        last = t = None
        fresh = True
        while True:
            if fresh:
                t = longest[pos]
                if t is None:
                    t = self.lone(s[pos])
            while t is not None:
                end = pos + size.get(t, 1)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        fits = self.steps(t) is not None
                    else:
                        fits = apart.get((last, t))
                        if fits is None:
                            fits = self.apart(last, t)
                    if fits:
                        break
                t = shorter[t] if t in shorter else self.shorter(t)
            if t is None:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[pos >> 3] |= 1 << (pos & 7)
                t = out.pop()
                pos -= size.get(t, 1)
                last = out[-1] if out else None
                t = shorter[t] if t in shorter else self.shorter(t)
                fresh = False
                continue
            out.append(t)
            last, pos, fresh = t, end, True
            if pos == n:
                return out

    def parts(self, s: str) -> list[str]:
        """``s`` cut between characters that stand side by side in no piece."""
        joins, out, start = self.joins, [], 0
        for i in range(1, len(s)):
            if s[i - 1:i + 1] not in joins:
                out.append(s[start:i])
                start = i
        out.append(s[start:])
        return out

    def code(self, segment: str) -> bytes:
        """Ids of a segment as little-endian 32-bit numbers."""
        known, out = self._parts, []
        for part in self.parts(segment.replace(" ", SPACE)):
            code = known.get(part)
            if code is None:
                ids = self.tokens(part)
                if min(ids) < 0:
                    ids = [i for t in ids for i in ([t] if t >= 0 else [self.byte[b] for b in chr(-1 - t).encode("utf-8")])]
                code = array("i", ids).tobytes()
                if len(part) <= segments.LONGEST_KEPT:
                    if len(known) > segments.MOST_KEPT:
                        known.clear()
                    known[part] = code
            out.append(code)
        return b"".join(out)

    def codes(self, segs: list[str]) -> list[bytes]:
        return [self.code(s) for s in segs]

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(self.prefix + text) if text else []


def encode(docs: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
           end_id: int | None = None, ids_col: str = "ids") -> DataFrame:
    """``keep`` and the ids of each text, closed by ``end_id`` if one is given.
    ``ids_col`` and ``text_col`` may not be names of ``keep``."""
    if ids_col in keep:
        raise ValueError(f"{ids_col!r} is in keep")
    tail = b"" if end_id is None else np.int32(end_id).astype("<i4").tobytes()

    def run(batches):
        known = segments.of_worker(("merges", model), lambda: segments.Remembered(MergeEncoder(model).codes))
        enc = known.encode.__self__
        for b in textio.text_pieces(batches, "_text"):
            cut = [enc.cut(t) for t in textio.texts_of(b, "_text")]
            of = known.learn(cut).__getitem__
            codes = [b"".join(map(of, x)) + tail for x in cut]
            offsets = np.zeros(len(codes) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in codes], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(codes), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], ids], names=[*keep, ids_col])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, `{ids_col}` array<int>")


def decode(rows: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``keep`` and the text of each row's ids, by the library's decoder. NULL
    ids give an empty text; an id outside the vocabulary is an error."""
    if text_col in keep:
        raise ValueError(f"{text_col!r} is in keep")

    def run(batches):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for b in batches:
            ids = b.column("_ids")
            text = [sp.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else "" for x in ids]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(text, pa.string())], names=[*keep, text_col])

    src = rows.select(*keep, F.col(ids_col).alias("_ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_ids")
    return src.mapInArrow(run, f"{kinds}, `{text_col}` string")


def digests(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """Per encoded row: n_tokens, the hash of its ids and of its decoded text."""
    both = decode(encoded, model, (*keep, ids_col), ids_col, "_decoded")
    return both.select(*keep, F.size(ids_col).cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(ids_col, " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"))
