"""Shared helpers: reading tables, walking Arrow batches in bounded pieces,
code-point arrays, hashed words and character n-grams in numpy.

Batches are cut into pieces of at most ``max_bytes`` of text (one longer text
is a piece of its own), so the memory of a task follows the longest text, not
the batch. Hashes use 32-bit wrap-around arithmetic and are the same in every
process.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = np.uint32(0x01000193)   # multiplier of the polynomial hash
MIX = np.uint32(0x9E3779B1)    # odd multiplier; the top bits of h * MIX are the bucket


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> SparkSession:
    """Lowers the session's limits of an Arrow batch, so that a batch of long
    texts fits beside the executor's heap."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int("".join(ch for ch in spark.conf.get(key) if ch.isdigit() or ch == "-"))
        if now <= 0 or now > most:
            spark.conf.set(key, most)
    return spark


def id_crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL id: NULL)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """All rows when there are at most ``limit``; else the rows whose hashed
    ``key`` falls in the leading share, about ``limit`` of them (the same rows
    on every run). ``key`` must be unique in ``df``."""
    n = df.count()
    if n <= limit:
        return df
    span = 1 << 30
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(span)) < int(span * limit / n))


def text_pieces(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0),
                          dtype=np.int64)
        start, total = 0, 0
        for i, s in enumerate(size):
            if total and total + s > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(s)
        if start < len(size):
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, NULL as the empty string."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` end to end, and the n + 1 offsets."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), offsets


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[start:end]`` per segment (rows of a matrix likewise).
    Each sum depends on its own segment only."""
    out = np.zeros((len(starts), *values.shape[1:]), dtype=np.float64)
    full = ends > starts
    if full.any():
        edges = np.empty(2 * int(full.sum()), dtype=np.int64)
        edges[0::2], edges[1::2] = starts[full], ends[full]
        if edges[-1] == len(values):  # the last segment runs to the end
            edges = edges[:-1]
        out[full] = np.add.reduceat(values, edges, axis=0, dtype=np.float64)[0::2]
    return out


def bucket(h: np.ndarray, bits: int, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt * 0x85EBCA6B & 0xFFFFFFFF)) * MIX
    h ^= h >> np.uint32(15)
    return (h * MIX) >> np.uint32(32 - bits)


def ngram_buckets(cp: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the joined texts, with each text's first and
    past-the-last position (grams across two texts lie outside both)."""
    m = max(len(cp) - n + 1, 0)
    h = cp[:m].copy()
    for k in range(1, n):
        h *= BASE
        h += cp[k:k + m]
    starts = offsets[:-1]
    return bucket(h, bits, n), starts, np.maximum(offsets[1:] - n + 1, starts)


_LOW = 0x2000  # code points below are looked up in a table, the rare others one by one


def word_chars(cp: np.ndarray) -> np.ndarray:
    """True at letters and digits."""
    table = np.array([chr(c).isalnum() for c in range(_LOW)], dtype=bool)
    out = table[np.minimum(cp, _LOW - 1)]
    high = np.flatnonzero(cp >= _LOW)
    if len(high):
        kinds, where = np.unique(cp[high], return_inverse=True)
        out[high] = np.array([chr(c).isalnum() for c in kinds], dtype=bool)[where]
    return out


_STEPS = 32  # characters hashed for all words at once; longer words are finished one by one


def word_hashes(cp: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Words are runs of letters and digits inside one text. Returns the start
    of each word and, by key, its hashes: key 0 the whole word, key p its first
    p characters (0 where the word is shorter)."""
    inside = word_chars(cp)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(cp)]
    begin[first] = inside[first]
    starts = np.flatnonzero(begin)
    stop = np.ones(len(cp) + 1, dtype=bool)      # where a word can't go on
    stop[:-1] = ~inside
    stop[offsets[1:]] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    length = ends - starts
    h = np.zeros(len(starts), dtype=np.uint32)
    out: dict[int, np.ndarray] = {}
    live = np.arange(len(starts))
    for k in range(max(_STEPS, *prefixes, 1)):
        live = live[length[live] > k]
        if not len(live) and k not in [p - 1 for p in prefixes]:
            continue
        h[live] = h[live] * BASE + cp[starts[live] + k] + np.uint32(1)
        if k + 1 in prefixes:
            p = np.zeros_like(h)
            p[live] = h[live]
            out[k + 1] = p
    done = max(_STEPS, *prefixes, 1)
    for w in live[length[live] > done].tolist():      # the same polynomial, the rest of the word in one product
        rest = cp[starts[w] + done:ends[w]] + np.uint32(1)
        powers = np.full(len(rest), BASE, dtype=np.uint32)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        h[w:w + 1] = h[w:w + 1] * (powers[-1:] * BASE) + (rest[::-1] * powers).sum(dtype=np.uint32)
    out[0] = h * BASE + length.astype(np.uint32)
    return starts, out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
