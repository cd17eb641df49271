"""Texts cut where no token can cross, for encoders that remember segments.

A text is cut before a run of separators that follows another character. A
vocabulary decides which separators are safe: whatever stands left of such a
cut cannot change the tokens right of it, so a text's tokens are those of its
segments, end to end, and a segment that occurs often is encoded once per
Python worker. Segments hold the whole text: nothing is dropped or shortened.
"""

from __future__ import annotations

import gc
import re
import sys
import types
from collections.abc import Callable, Iterable
from contextlib import contextmanager

LONGEST_KEPT = 64      # characters; longer segments are encoded each time they occur
MOST_KEPT = 500_000    # segments remembered by a Python worker before it starts anew; some 300 bytes each

# white space beyond the blank and U+0009 to U+000D (fixed values: White_Space of Unicode, and U+001C to U+001F)
RARE_SPACE = "\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
COMMON_SPACE = " \t\n\x0b\x0c\r"


def as_class(chars: Iterable[str]) -> str:
    return "".join(map(re.escape, sorted(chars)))


def safe_separators(pieces: Iterable[str], space: str = "\u2581") -> set[str]:
    """The separators that no piece has right after a character which is not
    one. The blank is ``space`` to the vocabulary."""
    blank = {*COMMON_SPACE, space} - {" "}
    inner = {(x, y) for p in pieces for x, y in zip(p, p[1:]) if y in blank}
    safe = blank
    while unsafe := {y for x, y in inner if y in safe and x not in safe}:
        safe = safe - unsafe
    return safe | ({" "} if space in safe else set())


def piece_pattern(separators: set[str]) -> re.Pattern:
    """Segments for a vocabulary of pieces with these safe separators."""
    both = as_class(separators)
    return re.compile(f"[{both}]*[^{both}]+|[{both}]+" if both else r"(?s).+")


def held_space(separators: Iterable[str] = COMMON_SPACE) -> str:
    """White space (a class) before which there is no cut. In texts without it
    ``byte_level_pattern`` finds what ``piece_pattern`` does."""
    return RARE_SPACE + as_class(set(COMMON_SPACE) - set(separators))


def byte_level_pattern(separators: Iterable[str] = COMMON_SPACE) -> re.Pattern:
    """Segments for byte-level vocabularies whose pre-tokenizer never joins a
    character with white space after it. Other white space before a separator
    belongs to the same run, so there is no cut between the two."""
    both = as_class(set(COMMON_SPACE) & set(separators))
    if not both:
        return re.compile(r"(?s).+")
    held = held_space(separators)
    more = f"(?<=[{held}])[{both}]+"
    return re.compile(f"[{both}]*[^{both}]+(?:{more}[^{both}]+)*(?:{more})?|[{both}]+")


class Remembered(dict):
    """segment -> code, filled by ``encode`` (a list of segments in, their
    codes out), which sees the missing segments of a batch together."""

    def __init__(self, encode: Callable[[list[str]], list]):
        super().__init__()
        self.encode = encode
        self.long: list[str] = []

    def learn(self, texts: list[list[str]]) -> Remembered:
        """Holds the codes of all segments of ``texts`` until the next call."""
        if len(self) > MOST_KEPT:
            self.clear()
        for s in self.long:
            self.pop(s, None)
        missing = list(set().union(*texts).difference(self))
        self.update(zip(missing, self.encode(missing)))
        self.long = [s for s in missing if len(s) > LONGEST_KEPT]
        return self


class Generations:
    """segment -> code for two generations of segments. When the young one holds
    more than ``most`` it becomes the old one, and the old one is forgotten but
    for what has come back: what occurs again and again stays. ``encode`` sees
    the missing segments of a batch together."""

    def __init__(self, encode: Callable[[list[str]], list], most: int):
        self.encode, self.most = encode, most
        self.young: dict = {}
        self.old: dict = {}

    def codes(self, segs: list[str]) -> list:
        """The codes of distinct segments."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        out = list(map(self.young.get, segs))
        new = [k for k, code in enumerate(out) if code is None]
        missing = []
        for k in new:
            out[k] = code = self.old.pop(segs[k], None)
            if code is None:
                missing.append(k)
        for k, code in zip(missing, self.encode([segs[k] for k in missing])):
            out[k] = code
        self.young.update((segs[k], out[k]) for k in new if len(segs[k]) <= LONGEST_KEPT)
        return out


@contextmanager
def without_cycle_search():
    """Python's search for reference cycles is off inside: remembered codes are
    many objects and no cycles, and it walks all of them again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def of_worker(key: tuple, make: Callable[[], object]):
    """The worker's own object of this key, kept from task to task. Code that
    is shipped by value has no module of its own in the worker, so one is made
    there. Only the last key is kept."""
    here = sys.modules.setdefault("tillwise_llm_worker", types.ModuleType("tillwise_llm_worker"))
    if getattr(here, "key", None) != key:
        here.kept, here.key = make(), key
    return here.kept
