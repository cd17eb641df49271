"""Secret scans (operator 3).

Three base kinds are found by pattern. Beyond them, maximal runs of a
character class (candidates) are searched with a sliding window: the Shannon
entropy of the window is kept up to date from incremental character counts
(one character leaves, one enters), and windows at or above the class's limit
make up a span. An allow-list suppresses entropy spans: UUIDs that hold the
span, names of digests that the span starts in or directly follows (behind a
blank or another sign it is no digest of that name), and what stands near a
placeholder word of the same value. In a URL each path segment is judged alone. Base spans are never suppressed, and
an entropy span lying inside a base span adds nothing and is left out.

Texts are read whole. A fast pattern test per batch picks the texts that can
hold a span at all; only those are walked in Python.

Edge cases: NULL and empty texts have no spans; repeated rows give repeated
results; spans of one kind never overlap; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textio

# The base kinds, in the order in which ties are listed.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24


@dataclass(frozen=True)
class CharClass:
    """A run of ``alphabet`` is a candidate; a window of ``window`` characters
    with at least ``bits`` of entropy and all of ``needs`` in it is a hit."""
    kind: str
    alphabet: str
    window: int
    bits: float
    needs: tuple[str, ...]


@dataclass(frozen=True)
class Params:
    classes: tuple[CharClass, ...] = (
        CharClass("entropy_hex", r"[0-9A-Fa-f]", 24, 3.0, (r"[0-9]", r"[A-Fa-f]")),
        CharClass("entropy_base64", r"[A-Za-z0-9+/_=-]", 20, 3.9, (r"[0-9]", r"[a-z]", r"[A-Z]")),
        CharClass("entropy_lower", r"[a-z0-9]", 20, 3.7, (r"[0-9]", r"[a-z]")),
        CharClass("entropy_upper", r"[A-Z0-9]", 20, 3.7, (r"[0-9]", r"[A-Z]")),
    )
    # allowed: a span inside a match of one of these
    covered: tuple[str, ...] = (r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",)
    # allowed: a span that starts in or right behind the name of a digest
    named: str = (r"(?i)(?<![a-z0-9_-])(?:(?:sha(?:1|224|256|384|512)|md5|crc(?:32)?)(?:[-/(]|[:=]\x20?)|"
                  r"(?:digest|checksum|etag|integrity|commit)[\"']?(?:\(|[:=]\x20?))[\"']?")
    # allowed: what stands nearer than ``near`` to one of these words in the same value (a name before "=" is another)
    words: str = r"(?i)example|placeholder|dummy|xxxx|0123456789|abcdefgh|changeme"
    near: int = 32
    # where this is found at the candidate, its path segments are judged one by one
    url: str = r"(?i)^\W*(https?|ftp|s3|gs|file)://[^?=]*$"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base kinds, unsorted."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]


def window_hits(run: str, width: int, bits: float) -> list[bool]:
    """Per window start: entropy of run[i:i+width] is at least ``bits``.
    With c_x the count of x, entropy = log2(width) - sum(c_x log2 c_x) / width."""
    cost = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    count: dict[str, int] = {}
    total = 0.0
    limit = (math.log2(width) - bits) * width + 1e-9
    out = []
    for i, x in enumerate(run):
        if i >= width:
            y = run[i - width]
            c = count[y]
            count[y] = c - 1
            total += cost[c - 1] - cost[c]
        c = count.get(x, 0)
        count[x] = c + 1
        total += cost[c + 1] - cost[c]
        if i >= width - 1:
            out.append(total <= limit)
    return out


def _around(text: str, start: int, end: int) -> str:
    """The candidate ``text[start:end]`` with up to 80 characters before and 32
    after it in its line."""
    near = max(0, start - 64)
    lo = max(near, text.rfind(" ", near, start) + 1, text.rfind("\n", near, start) + 1)
    return text[max(0, lo - 16):start].rpartition("\n")[2] + text[start:end + 32].split("\n")[0]


def _found(run: str, at: int, c: CharClass, needs: list[re.Pattern]) -> list[tuple[int, int]]:
    """Spans of a run that stands at ``at``."""
    start = end = -1
    found = []
    for i, hit in enumerate(window_hits(run, c.window, c.bits)):
        if hit and i > end:
            if end >= 0:
                found.append((start, end))
            start, end = i, i + c.window
        elif hit:
            end = i + c.window
    if end >= 0:
        found.append((start, end))
    return [(at + s, at + e) for s, e in found if all(n.search(run, s, e) for n in needs)]


def _allowed(text: str, s: int, e: int, covered: list[re.Pattern], named: re.Pattern) -> bool:
    if any(m.start() <= s and e <= m.end() for c in covered for m in c.finditer(text, max(0, s - 40), e + 40)):
        return True
    return any(m.start() <= s <= m.end() for m in named.finditer(text, max(0, s - 16), min(e, s + 16)))


def _clear(run: str, words: re.Pattern, near: int) -> list[tuple[int, int]]:
    """The stretches of a run that are not near a placeholder word of the same value."""
    out, done = [], 0
    for g in re.finditer("[^=]*=*", run):
        for m in words.finditer(run, *g.span()):
            out.append((done, max(done, g.start(), m.start() - near)))
            done = min(g.end(), m.end() + near)
    return [x for x in (*out, (done, len(run))) if x[0] < x[1]]


def entropy_spans(text: str, p: Params) -> list[tuple[int, int, str]]:
    out = []
    covered = [re.compile(a) for a in p.covered]
    named, words, url = re.compile(p.named), re.compile(p.words), re.compile(p.url)
    for c in p.classes:
        needs = [re.compile(n) for n in c.needs]
        for m in re.finditer(f"{c.alphabet}{{{c.window},}}", text):
            if not all(n.search(m[0]) for n in needs):
                continue
            parts = [(s, m[0][s:e]) for s, e in _clear(m[0], words, p.near)]
            found = [x for s, part in parts for x in _found(part, m.start() + s, c, needs)]
            if found and url.search(_around(text, *m.span())):
                found = [x for s, part in parts for g in re.finditer("[^/]+", part) for x in _found(g[0], m.start() + s + g.start(), c, needs)]
            out += [(s, e, c.kind) for s, e in found if not _allowed(text, s, e, covered, named)]
    return out


def scan(text: str, p: Params = Params()) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans), each by start, then kind as listed."""
    order = {k: i for i, k in enumerate((*BASE, *(c.kind for c in p.classes)))}
    base = sorted(base_spans(text), key=lambda s: (s[0], order[s[2]]))
    covered = [(s, e) for s, e, _ in base]
    more: list[tuple[int, int, str]] = []
    for kind, spans in groupby(entropy_spans(text, p), key=lambda x: x[2]):  # one class after another
        covered.sort()
        starts = [s for s, _ in covered]
        reach = list(accumulate((e for _, e in covered), max))   # furthest end of the spans up to here
        new = []
        for s, e, _ in spans:  # a class listed later adds nothing inside an earlier one's span
            i = bisect_right(starts, s)
            if not i or reach[i - 1] < e:
                new.append((s, e))
        more += [(s, e, kind) for s, e in new]
        covered += new
    return base, sorted(base + more, key=lambda s: (s[0], order[s[2]]))


def _suspects(col: pa.Array, p: Params) -> np.ndarray:
    tests = [r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{6}", r"AKIA[A-Z0-9]{16}",
             r"[0-9a-f]{24}", *(f"{c.alphabet}{{{c.window}}}" for c in p.classes)]
    out = np.zeros(len(col), dtype=bool)
    for t in tests:
        out |= np.asarray(pc.fill_null(pc.match_substring_regex(col, t), False))
    return out


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_documents(docs: DataFrame, params: Params = Params(), keep: tuple[str, ...] = ("doc_id",),
                   text_col: str = "text") -> DataFrame:
    """``keep`` columns, counts of the base kinds, base_sha256 and ``spans``
    (kind:start:end in code points, end exclusive, comma-joined)."""

    def run(batches):
        nothing = ([], [])
        for b in textio.text_pieces(batches, "_text"):
            col = b.column(b.schema.get_field_index("_text"))
            hot = _suspects(col, params)
            found = [scan(col[i].as_py(), params) if hot[i] else nothing for i in range(len(b))]
            base = [_joined(x[0]) for x in found]
            count = [pa.array([sum(k == kind for _, _, k in x[0]) for x in found], pa.int64()) for kind in BASE]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], *count, pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base]),
                 pa.array([_joined(x[1]) for x in found])],
                names=[*keep, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    src = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kinds}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, params: Params = Params(), text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlaps merged) replaced by ``mask``; other
    columns and texts without spans stay as they are."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for b in textio.text_pieces(batches, text_col):
            hot = np.flatnonzero(_suspects(b.column(at), params))
            if len(hot):
                texts = b.column(at).to_pylist()
                for i in hot:
                    text, out, done = texts[i], [], 0
                    for s, e, _ in scan(text, params)[1]:
                        if s >= done:
                            out += [text[done:s], mask]
                        done = max(done, e)
                    texts[i] = "".join(out) + text[done:]
                cols = [pa.array(texts, b.column(at).type) if i == at else b.column(i) for i in range(len(names))]
                b = pa.RecordBatch.from_arrays(cols, names=names)
            yield b

    return docs.mapInArrow(run, docs.schema)
