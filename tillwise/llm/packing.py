"""Best-fit packing by minimum bin slack (operator 2).

``tokenize`` turns documents into token pieces of at most ``capacity`` ids;
``pack`` puts pieces (any rows with a length) into sequences. Minimum bin
slack fills one bin at a time: the longest piece left opens the bin, and a
subset-sum dynamic programme over the lengths still available (a bitset of
reachable fillings per length) finds the fullest feasible completion, which is
then removed. The programme sees only how many pieces of each length are left,
so it runs on a histogram of at most ``capacity`` numbers, whatever the size of
the corpus; a filling is repeated as long as its lengths last, which removes
the same combination bin after bin.

Pieces then find their place by their rank among the pieces of the same
length. Ranks are taken inside (length, salt) groups whose size is bounded by
choosing the number of salts from the row count, plus the sum of the groups
before, so a length shared by a third of all rows never meets in one task.
Equal rows share their salt; a row that repeats beyond the size of a group
gets groups of its own, dealt by row number.

Edge cases: a NULL or empty text is one piece holding the end id only.
Repeated rows are packed each. Pieces of equal length are interchangeable;
their order is by the row's own columns. An empty table packs into no
sequences. Other columns of ``docs`` are ignored unless named in ``keep``.
"""

from __future__ import annotations

import os
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import segments, textio
from .align import LETTERS, SIGNS

JOINED = 1 << 14       # characters of missing segments encoded as one text
KEPT = 350_000         # segments in a generation that a Python worker remembers, of two; some 150 bytes each


@dataclass(frozen=True)
class Params:
    capacity: int = 1024
    end_id: int = 2
    rows_per_group: int = 500_000  # aimed at in a (length, salt) group, were all rows of one length


class Cutter:
    """Finds the segments of UTF-8 texts end to end (see ``segments``; what is
    cut is what ``byte_level_pattern`` cuts), and cuts a word from the signs
    behind it, as the pre-tokenizer always ends a token between a letter and a
    sign. Letters are those of LETTERS up to U+023F."""

    def __init__(self):
        self.space, self.sign, self.letter = (np.array([b < 128 and bool(re.match(f"[{x}]", chr(b))) for b in range(256)])
                                              for x in (segments.COMMON_SPACE, SIGNS, LETTERS))
        self.lead = np.zeros(256, dtype=bool)
        self.lead[0xC3:0xC9] = True                      # of U+00C0 to U+023F, two bytes each
        held = [c.encode() for c in map(chr, range(0x3001)) if re.match(f"[{segments.RARE_SPACE}]", c)]
        self.held = {n: [int.from_bytes(c) for c in held if len(c) == n] for n in (1, 2, 3)}

    def _behind_held(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether white space before which there is no cut ends at ``at``."""
        code, out = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=bool)
        for n, held in self.held.items():
            code |= data[np.maximum(at - n, 0)].astype(np.int64) << 8 * (n - 1)
            out |= np.isin(code, held)
        return out

    def borders(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where segments begin, in order, and the end of ``data``. ``ends``:
        where texts begin, and the end of ``data``."""
        space, letter = self.space[data], self.letter[data]
        if len(wide := np.flatnonzero(self.lead[data])):
            wide = wide[(data[wide] != 0xC3) | (data[wide + 1] & 0xDF != 0x97)]     # U+00D7 and U+00F7 are signs
            letter[wide] = letter[wide + 1] = True
        blank = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        odd = (data[blank - 1] >= 0x80) | (data[blank - 1] < 0x20)
        blank = np.concatenate([blank[~odd], blank[odd][~self._behind_held(data, blank[odd])]])
        turn = np.flatnonzero(letter[1:] != letter[:-1]) + 1                       # words begin and end by turns
        start, stop = (turn[1::2], turn[2::2]) if letter[:1].any() else (turn[0::2], turn[1::2])
        start = start[:len(stop)]
        stem = stop[space[start - 1] & self.sign[data[stop]]]                      # no token added to the vocabulary spans it
        is_cut = np.zeros(len(data) + 1, dtype=bool)
        is_cut[blank] = is_cut[stem] = is_cut[ends] = True
        return np.flatnonzero(is_cut)


class Encoder:
    """Token ids of a byte-level vocabulary by ``tokenizers``. Texts are cut
    into segments that no token crosses, each encoded once per worker. The
    segments a batch is missing are encoded side by side as one text, whose
    tokens are told apart by the bytes that they stand for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = self.model.get_added_tokens_decoder()
        sizes = {i: len(t) for t, i in self.model.get_vocab().items()} | {i: len(t.content.encode()) for i, t in added.items()}
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], dtype=np.int64)   # one character stands for one byte
        # an added token with white space, or with a letter in front, could lie across a cut
        self.whole = any(t.lstrip or t.rstrip or re.search(rf"\s|^[{LETTERS}]", t.content) for t in added.values())
        self.cutter = Cutter()
        self.known = segments.Generations(self.codes, KEPT)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def codes(self, segs: list[str]) -> list[bytes]:
        out = [b""] * len(segs)
        group: list[int] = []
        chars = 0
        for k, s in enumerate(segs):
            # what begins with a separator and does not end with white space can stand beside others
            if len(s) <= segments.LONGEST_KEPT and s[0] in segments.COMMON_SPACE and not s[-1].isspace():
                group.append(k)
                chars += len(s)
                if chars > JOINED:
                    self._joined(segs, group, out)
                    group, chars = [], 0
            else:
                out[k] = self.ids(s).tobytes()
        self._joined(segs, group, out)
        return out

    def _joined(self, segs: list[str], group: list[int], out: list[bytes]) -> None:
        if not group:
            return
        ids = self.ids("".join(segs[k] for k in group))
        ends = np.cumsum(self.sizes[ids])
        borders = np.cumsum([len(segs[k].encode()) for k in group])
        last = np.searchsorted(ends, borders)
        if ends[-1] != borders[-1] or (ends[last] != borders).any():
            raise ValueError("a token crosses the border of a segment")
        code, stop = ids.tobytes(), ((last + 1) * 4).tolist()
        for k, i, j in zip(group, [0, *stop], stop):
            out[k] = code[i:j]

    def batch(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the n + 1 offsets. NULL is empty."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else pc.fill_null(texts.cast(pa.string()), "")
        _, places, content = texts.buffers()
        ends = np.frombuffer(places, dtype=np.int32)[texts.offset:][:len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int32)
        if ends[0] == ends[-1]:
            return np.zeros(0, dtype="<u4"), np.zeros(len(ends), dtype=np.int64)
        data = np.frombuffer(content, dtype=np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        borders = np.unique(ends) if self.whole else self.cutter.borders(data, ends)
        found = pa.StringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        with segments.without_cycle_search():
            codes = self.known.codes(found.dictionary.to_pylist())
        of = np.asarray(found.indices)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        n = sizes[of]
        last = np.cumsum(n)
        ids = np.frombuffer(b"".join(codes), dtype="<u4")[np.arange(last[-1]) + np.repeat((np.cumsum(sizes) - sizes)[of] - (last - n), n)]
        return ids, np.append(0, last)[np.searchsorted(borders, ends)]


def tokenize(docs: DataFrame, tokenizer: str, params: Params = Params(), keep: tuple[str, ...] = ("doc_id",),
             text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep``, piece, start, length, ids_crc32 and, on
    request, the ids. A text's ids end with ``end_id``. Only longer ones are
    cut; all pieces but the first hold ``capacity`` ids."""
    cap = params.capacity
    if clash := set(keep) & {"piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}:
        raise ValueError(f"{sorted(clash)} are names of the result")

    def run(batches):
        enc = segments.of_worker(("packing", tokenizer), lambda: Encoder(tokenizer))
        for b in textio.text_pieces(batches, "_text", 8 << 20):
            ids, offsets = enc.batch(b.column(b.schema.get_field_index("_text")))
            at = np.arange(1, len(b) + 1)
            ids = np.insert(ids, offsets[1:], np.uint32(params.end_id)).astype("<u4")
            first, last = offsets[:-1] + at - 1, offsets[1:] + at
            total = last - first
            pieces = -(-total // cap)
            row = np.repeat(np.arange(len(b)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lead = total - (pieces - 1) * cap          # length of the first piece
            start = np.where(piece == 0, 0, lead[row] + (piece - 1) * cap)
            length = np.where(piece == 0, lead[row], cap)
            lo = first[row] + start
            crc = [zlib.crc32(ids[i:i + n]) for i, n in zip(lo.tolist(), length.tolist())]
            cols = [*[b.column(c).take(pa.array(row)) for c in keep], pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [*keep, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([ids[i:i + n] for i, n in zip(lo.tolist(), length.tolist())], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum bin slack on a histogram length -> count: a list of (number of
    bins, [(length, pieces of it per bin)]) that uses every piece."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        lengths = sorted(left, reverse=True)
        top = lengths[0]
        room = capacity - top
        inside = (1 << (room + 1)) - 1
        reach, layers = 1, []
        for n in lengths:
            if n > room:
                continue
            spare = min(left[n] - (n == top), room // n)
            layers.append((n, reach))
            step = 1
            while spare > 0:
                step = min(step, spare)
                reach |= (reach << (step * n)) & inside
                spare -= step
                step *= 2
            if reach >> room & 1:
                break
        rest = reach.bit_length() - 1
        bin_ = {top: 1}
        for n, before in reversed(layers):
            while not before >> rest & 1:
                rest -= n
                bin_[n] = bin_.get(n, 0) + 1
        times = min(left[n] // k for n, k in bin_.items())
        out.append((times, sorted(bin_.items(), reverse=True)))
        for n, k in bin_.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def _places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length the stretches of ranks that a filling takes: first rank,
    first bin, pieces per bin, offset of the first piece in the bin."""
    taken: dict[int, int] = {}
    rows: dict[int, list] = {}
    bin0 = 0
    for times, items in plan:
        offset = 0
        for n, k in items:
            rows.setdefault(n, []).append((taken.get(n, 0), bin0, k, offset))
            taken[n] = taken.get(n, 0) + times * k
            offset += n * k
        bin0 += times
    return {n: np.array(x, dtype=np.int64) for n, x in rows.items()}


def _salted(pieces: DataFrame, cols: list, length_col: str, salts: int, params: Params) -> DataFrame:
    """``pieces`` with their group: _salt, and for a row that repeats more than
    ``rows_per_group`` times its hash (_row) and a number (_part), else 0."""
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int"))
    large = salted.groupBy(length_col, "_salt").count().filter(F.col("count") > params.rows_per_group)
    plain = salted.withColumn("_row", F.lit(0).cast("long")).withColumn("_part", F.lit(0).cast("long"))
    if large.isEmpty():
        return plain
    of = F.xxhash64(*cols)
    hot = cut_lineage(salted.join(F.broadcast(large.drop("count")), [length_col, "_salt"]).groupBy(of.alias("_hot")).count()
                            .filter(F.col("count") > params.rows_per_group))   # at most rows / rows_per_group
    parts = F.ceil(F.col("count") / params.rows_per_group)
    return cut_lineage(salted.withColumn("_no", F.monotonically_increasing_id()).join(F.broadcast(hot), of == F.col("_hot"), "left")
                             .withColumn("_row", F.coalesce("_hot", F.lit(0).cast("long")))
                             .withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_no"), parts), F.lit(0).cast("long")))
                             .select(*salted.columns, "_row", "_part"))


def pack(pieces: DataFrame, params: Params = Params(), length_col: str = "length") -> DataFrame:
    """Every row of ``pieces`` with ``sequence_id`` and ``offset``. Lengths
    are 1 to ``capacity``; ``pieces`` is read three times, so pass a written
    table or something cheap."""
    cols = [F.col(c) for c in pieces.columns if c not in ("ids",)]
    totals = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}  # at most ``capacity`` rows
    salts = max(16, -(-sum(totals.values()) // params.rows_per_group))
    salted = _salted(pieces, cols, length_col, salts, params)
    group = [length_col, "_salt", "_row", "_part"]
    before = (salted.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
                    .withColumn("_before", F.sum("_n").over(Window.partitionBy(length_col).orderBy(*group[1:])) - F.col("_n"))
                    .drop("_n"))
    ranked = (salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*cols)) - 1)
                    .join(before, group)
                    .withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", *group[1:]))
    places = _places(fillings(totals, params.capacity))  # its size follows the number of lengths, not of rows
    names = pieces.columns

    def run(batches):
        for b in batches:
            rank = np.asarray(b.column("_rank"), dtype=np.int64)
            length = np.asarray(b.column(length_col), dtype=np.int64)
            bin_, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                p = places[int(n)]
                s = np.searchsorted(p[:, 0], rank[at], side="right") - 1
                j = rank[at] - p[s, 0]
                bin_[at] = p[s, 1] + j // p[s, 2]
                offset[at] = p[s, 3] + j % p[s, 2] * n
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(bin_), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "_rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, params: Params = Params(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Tokenise, write the piece table to the checkpoint folder, pack."""
    return pack(cut_lineage(tokenize(docs, tokenizer, params, keep)), params)
