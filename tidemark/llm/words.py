"""Words of many texts as numpy arrays: no Python object per word."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Characters handled at once; a longer text is still one piece.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, so that low bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is part of a word (letters and marks), and its lower case."""
    points = range(0x110000)
    letter = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in points), bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in points:
        if letter[c]:
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
    return letter, lower


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about CHUNK characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Words:
    raw: np.ndarray  # code points of all texts, one separator after each
    codes: np.ndarray  # the same in lower case
    offset: np.ndarray  # where each text begins in codes
    start: np.ndarray  # of each word, in codes
    size: np.ndarray
    doc: np.ndarray  # the text that a word is in

    def hashes(self) -> np.ndarray:
        """A 64-bit value per word, the same for equal words in any text."""
        reach = int(self.size.max(initial=0))
        powers = np.ones(reach + 1, np.uint64)
        powers[1:] = np.multiply.accumulate(np.full(reach, _BASE))
        total = np.zeros(len(self.size), np.uint64)
        order = np.argsort(-self.size, kind="stable")
        start, size = self.start[order], self.size[order]
        part = np.zeros(len(size), np.uint64)
        for i in range(min(reach, 24)):
            n = np.searchsorted(-size, -i, side="left")
            part[:n] += (self.codes[start[:n] + i].astype(np.uint64) + np.uint64(1)) * powers[i]
        for k in range(np.searchsorted(-size, -24, side="left")):  # the few long words
            rest = self.codes[start[k] + 24 : start[k] + size[k]].astype(np.uint64)
            part[k] += ((rest + np.uint64(1)) * powers[24 : 24 + len(rest)]).sum(dtype=np.uint64)
        total[order] = part
        return mixed(total + self.size.astype(np.uint64))


def words(texts: Sequence[str | None]) -> Words:
    """Runs of letters in lower case. A null text has none."""
    letter, lower = tables()
    texts = [t or "" for t in texts]
    codes = code_points("\n".join([*texts, ""]))
    offset = np.zeros(len(texts) + 1, np.int64)
    offset[1:] = np.cumsum([len(t) + 1 for t in texts])
    inside = letter[codes]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start = np.flatnonzero(edge == 1)
    size = np.flatnonzero(edge == -1) - start
    doc = np.searchsorted(offset, start, side="right") - 1
    return Words(codes, lower[codes], offset[:-1], start, size, doc)


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... ``count[0]`` of them, then those of start[1], and so on."""
    if not len(count):
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(ends[-1]) + np.repeat(start - (ends - count), count)
