"""Token ids and counts of whole texts by a library tokenizer, one call per distinct piece.

A tokenizer that first splits a text at places which do not depend on what is around a piece
gives the same ids for the piece alone. So pieces are split here, where a text has plain
characters only, and each distinct one is encoded by the library once per worker and cache
generation. Any other text goes to the library whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import Any

import numpy as np

from tidemark.llm import memory

#: Entries in a generation of a worker's cache; it holds two.
GENERATION = 250_000
#: Characters of texts that are handled at once.
AT_ONCE = 1 << 20
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Outside of ASCII and these Latin letters, normal forms, lower case and classes of
# characters need the library's own tables; "<|" may begin a special token.
_NOT_PLAIN = re.compile(rf"[^\t\n\x0b\x0c\r -~{_LETTERS}]|<\|").search
# The two splits that the tokenizers' files name, for plain characters.
word_pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+").findall
byte_pieces = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
).findall

_tokenizers: dict[str, Any] = {}


def tokenizer(place: Callable[[], str]) -> tuple[str, Any]:
    """The library's tokenizer for a file; loaded once in a process."""
    path = place()
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _tokenizers[path] = loaded
    return path, _tokenizers[path]


@functools.cache
def _word_ends(path: str) -> np.ndarray:
    """Per id of a loaded tokenizer: whether it ends a word."""
    vocabulary = _tokenizers[path].get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return ends


def plain(text: str) -> bool:
    return _NOT_PLAIN(text) is None


class Cache:
    """What the library gave for pieces, in two generations: what the older one holds and is
    asked for again moves to the newer; the rest goes when that is full."""

    def __init__(self, at_once: int = 10_000, generation: int = GENERATION) -> None:
        self.at_once, self.generation = at_once, generation
        self.new: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def holding(self, pieces: set[str], encode: Callable[[list[str]], Sequence]) -> dict[str, Any]:
        """A mapping that has every one of ``pieces``."""
        missing = pieces.difference(self.new)
        if len(self.new) + len(missing) > self.generation:
            self.old, self.new, missing = self.new, {}, pieces
        old = self.old
        ask = []
        for piece in missing:
            if piece in old:
                self.new[piece] = old[piece]
            else:
                ask.append(piece)
        for i in range(0, len(ask), self.at_once):
            part = ask[i : i + self.at_once]
            self.new.update(zip(part, encode(part)))
        return self.new


def _parts(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= AT_ONCE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_ids(texts: Sequence[str | None], place: Callable[[], str]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit, for a tokenizer that lower-cases
    and drops white space. A null text has none."""
    path, library = tokenizer(place)

    ends = _word_ends(path)

    def encode(part: list[str]) -> list[bytes]:
        found = library.encode_batch_fast(part, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode_pieces(part: list[str]) -> list[bytes]:
        """Pieces in few calls: side by side, their ids are told apart by the ends of words."""
        lines = [part[i : i + 500] for i in range(0, len(part), 500)]
        found = library.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)
        out: list[bytes] = []
        for line, e in zip(lines, found):
            ids = np.array(e.ids, "<u4")
            last = (np.flatnonzero(ends[ids]) + 1) * 4
            if len(last) != len(line):
                out.extend(encode(line))
                continue
            joined, edges = ids.tobytes(), [0, *last.tolist()]
            out.extend(joined[a:b] for a, b in zip(edges, edges[1:]))
        return out

    cache = memory.store("word ids").setdefault(path, Cache())
    out: list[bytes] = []
    for a, b in _parts(texts):
        split = [word_pieces(t.lower()) if t and plain(t) else [] for t in texts[a:b]]
        known = cache.holding(set(chain.from_iterable(split)), encode_pieces).__getitem__
        for text, pieces in zip(texts[a:b], split):
            out.append(b"".join(map(known, pieces)) if pieces or not text else encode([text])[0])
    return out


def byte_counts(
    texts: Sequence[str | None], place: Callable[[], str], frequent: dict[str, int]
) -> list[int]:
    """Number of tokens of each text: lengths of frequent pre-tokens from ``frequent``, of
    others from the worker's cache, which the library fills. A null text has none."""
    path, library = tokenizer(place)

    def encode(part: list[str]) -> list[int]:
        return [len(e.ids) for e in library.encode_batch_fast(part, add_special_tokens=False)]

    cache = memory.store("byte counts").setdefault(path, Cache())
    out: list[int] = []
    for a, b in _parts(texts):
        totals, rare = [], []
        for text in texts[a:b]:
            found = byte_pieces(text) if text and plain(text) else []
            lengths = list(map(frequent.get, found))
            unknown = [p for p, n in zip(found, lengths) if n is None]
            total = sum(filter(None, lengths))
            totals.append(total if found or not text else encode([text])[0])
            rare.append(unknown)
        known = cache.holding(set(chain.from_iterable(rare)), encode).__getitem__
        out.extend(total + sum(map(known, unknown)) for total, unknown in zip(totals, rare))
    return out
