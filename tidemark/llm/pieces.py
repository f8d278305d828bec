"""SentencePiece encoding by suffix-array matching, and decoding."""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.tokens import Cache
from tidemark.llm.words import chunks, spread

SPACE = "▁"
#: Longest piece that matching handles, as a power of two: four characters fill a key.
LONGEST = 16
#: Words that are matched at once.
WORDS = 25_000
#: Pairs of pieces that a worker remembers.
PAIRS = 3_000_000
_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """What a model file holds, arranged for matching. Pieces within words have at most one
    space mark, at their start; pieces of space marks alone make up runs of spaces."""

    ids: dict[str, int]
    spaces: dict[int, int]  # length of a run of space marks -> id
    byte: list[int]  # id of each byte's piece
    decoded: list[bytes]  # what an id stands for
    alphabet: dict[str, int] = field(default_factory=dict)
    matched: np.ndarray = None  # ids of the pieces that can result, and their characters
    length: np.ndarray = None
    codes: np.ndarray = None
    def __post_init__(self) -> None:
        usable = [(p, i) for p, i in self.ids.items() if self.merged(p) == [i]]
        for p, _ in usable:
            for c in p:
                self.alphabet.setdefault(c, len(self.alphabet) + 2)
        self.matched = np.array([i for _, i in usable], np.int64)
        self.length = np.array([len(p) for p, _ in usable], np.int64)
        self.codes = np.zeros((len(usable), LONGEST), np.uint64)
        for row, (p, _) in enumerate(usable):
            self.codes[row, : len(p)] = [self.alphabet[c] for c in p]
        self.size = np.ones(max(self.ids.values()) + 2, np.int64)
        self.size[self.matched] = self.length
        self.unknown = len(self.size) - 1
        self._edges_of_pieces(usable)
        # Pairs of pieces asked for so far, and whether they may stand together.
        self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.asked: list[tuple[np.ndarray, np.ndarray]] = []

    def _edges_of_pieces(self, usable: list[tuple[str, int]]) -> None:
        """For every piece, what stands at its right and left edge while it is merged: the
        piece, its last (first) part, that part's last part, and so on; and the id of the
        merge that uses each up."""
        n = len(self.size)
        shape = (n, LONGEST)
        self.right, self.right_until = np.full(shape, -1, np.int64), np.full(shape, n, np.int64)
        self.left, self.left_until = np.full(shape, -1, np.int64), np.full(shape, n, np.int64)
        self.born = np.full(n, -1, np.int64)  # the merge that makes a piece; letters are there
        self.hash = np.zeros(n, np.uint64)
        halves = {}
        for p, i in usable:
            self.hash[i] = self._hash(p)
            if len(p) > 1:
                self.born[i] = i
                halves[i] = self._halves(p)
        for _, i in usable:
            for spine, until, side in ((self.right, self.right_until, 1), (self.left, self.left_until, 0)):
                part, depth = i, 0
                while True:
                    spine[i, depth] = part
                    if part not in halves:
                        break
                    until[i, depth + 1] = part
                    part, depth = halves[part][side], depth + 1
        self.powers = _HASH_BASE ** np.arange(LONGEST + 1, dtype=np.uint64)
        order = np.argsort(self.hash[self.matched])
        self.by_hash, self.hashes = self.matched[order], self.hash[self.matched][order]
        if len(np.unique(self.hashes)) < len(self.hashes):
            raise ValueError("pieces share a hash")
        # Merges run in order of ids only if no part is made by a later merge than its whole.
        if any(h > i and self.born[h] >= 0 for i, hs in halves.items() for h in hs):
            raise ValueError("a piece is older than its parts")

    @staticmethod
    def _hash(text: str) -> np.uint64:
        value = 0
        for c in text:
            value = (value * int(_HASH_BASE) + ord(c) + 1) % (1 << 64)
        return np.uint64(value)

    def _halves(self, piece: str) -> tuple[int, int]:
        """The two pieces that the last merge of a piece joins."""
        parts = list(piece)
        while len(parts) > 2:
            _, at = min((self.ids.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ids[parts[0]], self.ids[parts[1]]

    def merged(self, text: str) -> list[int]:
        """Pieces of a short text by pair merges: always the neighbours whose joint piece has
        the lowest id, the first of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = min(
                (self.ids.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if best == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(p, -1) for p in parts]

    @functools.cache
    def run(self, n: int) -> bytes:
        """Ids of ``n`` space marks in a row: these merge last and all alike, so from the left."""
        parts = [1] * n
        at = 0
        while at < len(parts) - 1:
            if parts[at] + parts[at + 1] in self.spaces:
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                at = max(0, at - 1)  # the grown piece may now merge with the one before
            else:
                at += 1
        return np.array([self.spaces[p] for p in parts], "<u4").tobytes()

    __hash__ = object.__hash__

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the joint text of two pieces gives just these two."""
        keys, inverse = np.unique(left * 65_536 + right, return_inverse=True)
        out = np.zeros(len(keys), bool)
        new = np.ones(len(keys), bool)
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            new = self.pairs[at] != keys
            out[~new] = self.fits[at[~new]]
        if new.any():
            out[new] = ~self._cross(keys[new] >> 16, keys[new] & 65_535)
            self.asked.append((keys[new], out[new]))
        return out[inverse]

    def remember(self) -> None:
        """Add the pairs asked for since the last call to the known ones, up to a bound."""
        if not self.asked:
            return
        keys = np.concatenate([self.pairs, *[k for k, _ in self.asked]])
        fits = np.concatenate([self.fits, *[f for _, f in self.asked]])
        self.asked = []
        self.pairs, first = np.unique(keys, return_index=True)
        self.fits = fits[first]
        if len(self.pairs) > PAIRS:
            self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)

    def _cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a merge would cross the border between two pieces.

        Merges run by id, so that what is at an edge stands there from the merge that made it
        to the one that uses it up. A part at the right edge of ``a`` and one at the left edge
        of ``b`` merge if they stand there together, their joint piece exists, and its id
        comes before what uses them up. Of equal ids the left one merges first.
        """
        crossed = np.zeros(len(a), bool)
        for i in range(LONGEST):
            for j in range(LONGEST):
                rest = np.flatnonzero(~crossed & (self.right[a, i] >= 0) & (self.left[b, j] >= 0))
                if not len(rest):
                    break
                x, y = self.right[a[rest], i], self.left[b[rest], j]
                x_until, y_until = self.right_until[a[rest], i], self.left_until[b[rest], j]
                joint = self.hash[x] * self.powers[self.size[y]] + self.hash[y]
                at = np.minimum(np.searchsorted(self.hashes, joint), len(self.hashes) - 1)
                merge = self.by_hash[at]
                there = (self.hashes[at] == joint) & (self.size[x] + self.size[y] <= LONGEST)
                together = (self.born[y] < x_until) & (self.born[x] <= y_until)
                crossed[rest] = there & together & (merge < x_until) & (merge <= y_until)
        return crossed


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """A BPE model's vocabulary; loaded once in a process."""
    if path not in _vocabularies:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, spaces, byte, decoded = {}, {}, [0] * 256, []
        for i in range(len(model)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                decoded.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                if piece.strip(SPACE) == "":
                    spaces[len(piece)] = i
                if SPACE not in piece[1:] and len(piece) <= LONGEST:
                    ids[piece] = i
                elif piece.strip(SPACE):
                    raise ValueError(f"a piece that spans words or is too long: {piece!r}")
                decoded.append(piece.replace(SPACE, " ").encode())
        _vocabularies[path] = Vocabulary(ids, spaces, byte, decoded)
    return _vocabularies[path]


def _edges(codes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All places (position, row of piece) where a piece stands in the text.

    The suffix array orders positions by their next 16 characters, by doubling: 4 characters
    are a key, ranks of two keys the key of 8, ranks of those the key of 16. As each order
    refines the one before, a piece's places are one range, which binary search finds: its
    first characters by rank, the rest as a range of keys.
    """
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(LONGEST, np.uint64)))
    key4 = sum(padded[i : i + n] << np.uint64(48 - 16 * i) for i in range(4))
    distinct4, rank4 = np.unique(key4, return_inverse=True)
    ranks = np.concatenate((rank4.astype(np.uint64) + np.uint64(1), np.zeros(LONGEST, np.uint64)))
    key8 = (ranks[:n] << np.uint64(32)) | ranks[4 : n + 4]
    distinct8, rank8 = np.unique(key8, return_inverse=True)
    ranks = np.concatenate((rank8.astype(np.uint64) + np.uint64(1), np.zeros(LONGEST, np.uint64)))
    key16 = (ranks[:n] << np.uint64(32)) | ranks[8 : n + 8]
    suffixes = np.argsort(key16, kind="stable")
    sorted16 = key16[suffixes]

    def range4(chars: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of keys that begin with the first ``count`` of four characters."""
        low = sum(chars[:, i] << np.uint64(48 - 16 * i) for i in range(4))
        rest = np.where(count >= 4, 0, 64 - 16 * np.minimum(count, 4)).astype(np.uint64)
        open_end = np.where(count >= 4, np.uint64(0), (np.uint64(1) << np.minimum(rest, np.uint64(63))) - np.uint64(1))
        open_end = np.where(count <= 0, np.uint64(0xFFFFFFFFFFFFFFFF), open_end)
        low_at = np.searchsorted(distinct4, low, side="left")
        high_at = np.searchsorted(distinct4, low | open_end, side="right")
        # Rank 0 is past the end of the text, which only an unconstrained part may be.
        return np.where(count <= 0, 0, low_at + 1), np.where(count <= 0, len(distinct4) + 1, high_at + 1)

    def range8(chars: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = range4(chars[:, :4], np.minimum(count, 4))
        c, d = range4(chars[:, 4:], count - 4)
        low = np.searchsorted(distinct8, (a.astype(np.uint64) << np.uint64(32)) | c.astype(np.uint64))
        # With all of the first four given, a and b differ by at most one rank.
        top = np.maximum(b, 1).astype(np.uint64) - np.uint64(1)
        high = np.searchsorted(distinct8, (top << np.uint64(32)) | d.astype(np.uint64))
        empty = (b <= a) | (d <= c)
        low, high = np.where(empty, 0, low + 1), np.where(empty, 0, high + 1)
        return np.where(count <= 0, 0, low), np.where(count <= 0, len(distinct8) + 1, high)

    a, b = range8(v.codes[:, :8], np.minimum(v.length, 8))
    c, d = range8(v.codes[:, 8:], v.length - 8)
    low = np.searchsorted(sorted16, (a.astype(np.uint64) << np.uint64(32)) | c.astype(np.uint64))
    top = np.maximum(b, 1).astype(np.uint64) - np.uint64(1)
    high = np.searchsorted(sorted16, (top << np.uint64(32)) | d.astype(np.uint64))
    count = np.where((b <= a) | (d <= c), 0, np.maximum(high - low, 0))
    return suffixes[spread(low, count)], np.repeat(np.arange(len(v.length)), count)


def encode_words(words: Sequence[str], v: Vocabulary) -> list[bytes]:
    """Ids of words that begin with their space mark, as little-endian unsigned 32-bit.

    Every piece is matched against the words' joint text, and the matches, as edges between
    positions, are relaxed in order of where they end: a position's last piece is the one
    that may stand after the last piece at the place where it starts. Merging gives each
    prefix of a word exactly one such piece, so what is found is what merging gives.
    Characters that no piece has become their bytes' pieces.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # a separator before each word
    text = "\0".join(["", *words])
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    present, inverse = np.unique(raw, return_inverse=True)
    code_of = np.array([v.alphabet.get(chr(c), 1) for c in present.tolist()], np.uint64)
    codes = code_of[inverse]
    codes[starts - 1] = 0
    at, row = _edges(codes, v)
    odd = np.flatnonzero(codes == 1)
    begin = np.concatenate((at, odd))
    piece = np.concatenate((v.matched[row], np.full(len(odd), v.unknown)))
    end = begin + np.concatenate((v.length[row], np.ones(len(odd), np.int64)))
    word = np.searchsorted(starts, begin, side="right") - 1
    step = end - starts[word]
    order = np.lexsort((end, step))
    begin, piece, end, step, word = (x[order] for x in (begin, piece, end, step, word))
    last = np.full(len(codes) + 1, -1, np.int64)  # the last piece of the prefix that ends here
    bounds = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1], [True]))) if len(step) else []
    for a, b in zip(bounds[:-1], bounds[1:]):
        s, p = begin[a:b], piece[a:b]
        opens = s == starts[word[a:b]]
        before = np.where(opens, v.unknown, last[s])
        free = opens | (before == v.unknown) | (p == v.unknown)
        good = free & (before >= 0)
        ask = ~free & (before >= 0)
        if ask.any():
            good[ask] = v.compatible(before[ask], p[ask])
        last[end[a:b][good]] = p[good]
    v.remember()
    # From the ends back, one piece of every word at a time.
    here, left = starts + sizes, np.arange(len(words))
    pieces, owners = [], []
    while len(left):
        found = last[here[left]]
        pieces.append(found)
        owners.append(left)
        here[left] -= v.size[found]
        left = left[here[left] > starts[left]]
    flat = np.concatenate(pieces[::-1]) if pieces else np.zeros(0, np.int64)
    owner = np.concatenate(owners[::-1]) if pieces else flat
    order = np.argsort(owner, kind="stable")
    joined = flat[order].astype("<u4").tobytes()
    edges = 4 * np.searchsorted(owner[order], np.arange(len(words) + 1))
    out = [joined[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    for w in np.unique(owner[flat == v.unknown]).tolist():
        out[w] = _with_bytes(words[w], np.frombuffer(out[w], "<u4").tolist(), v)
    return out


def _with_bytes(word: str, ids: list[int], v: Vocabulary) -> bytes:
    at, result = 0, []
    for p in ids:
        if p == v.unknown:
            result.extend(v.byte[x] for x in word[at].encode("utf-8", "replace"))
        else:
            result.append(p)
        at += int(v.size[p])
    return np.array(result, "<u4").tobytes()


def encode_texts(texts: Sequence[str | None], path: str) -> list[bytes]:
    """Ids of whole texts. Words are matched once per worker and cache generation.

    No piece goes on over a space or line end, so a text is encoded by lines and words: the
    words after a space mark, and those that open a line but the first, have caches of their
    own. A run of space marks is encoded as one, with the mark that a word did not use.
    """
    v = vocabulary(path)
    kept = memory.store("pieces")
    marked = kept.setdefault((path, "marked"), Cache(WORDS, 200_000))
    opening = kept.setdefault((path, "opening"), Cache(WORDS, 50_000))
    lone = np.array([v.spaces[1]], "<u4").tobytes()
    line_end = np.array([v.byte[10]], "<u4").tobytes()
    split_lines = "\n" not in v.alphabet
    out: list[bytes] = []
    for a, b in chunks(texts):
        split = []
        for t in texts[a:b]:
            t = (t or "").replace(SPACE, " ")
            split.append([line.split(" ") for line in (t.split("\n") if split_lines else [t])] if t else [])
        after, heads = set(), set()
        for lines in split:
            for i, parts in enumerate(lines):
                after.update(parts[1:] if i else parts)
                if i:
                    heads.add(parts[0])
        after.discard("")
        heads.discard("")
        word = marked.holding(after, lambda ps: encode_words([SPACE + p for p in ps], v)).__getitem__
        head = opening.holding(heads, lambda ps: encode_words(ps, v))
        for lines in split:
            found: list[bytes] = []
            for i, parts in enumerate(lines):
                if i:
                    found.append(line_end)
                    if parts[0]:
                        found.append(head[parts[0]])
                    parts = parts[1:]
                if "" not in parts:
                    found.extend(map(word, parts))
                    continue
                marks = 0
                for part in parts:
                    marks += 1
                    if part:
                        ids = word(part)
                        if ids.startswith(lone):
                            found += (v.run(marks), ids[4:])
                        else:
                            found += (v.run(marks - 1), ids)
                        marks = 0
                found.append(v.run(marks))
            out.append(b"".join(found))
    return out


def decode_ids(ids: np.ndarray, path: str) -> str:
    """The text of a sequence of ids: bytes that are no UTF-8 become U+FFFD."""
    v = vocabulary(path)
    joined = b"".join(map(v.decoded.__getitem__, ids.tolist()))
    return joined.removeprefix(b" ").decode("utf-8", "replace")


def encode(place: Callable[[], str], text_column: str = "text") -> Column:
    """Column of array<int>: the pieces of a whole text by a BPE model of the SentencePiece
    library whose normalisation keeps text as it is and marks spaces. A null or empty text has
    none. ``place`` names the model's file on the machine that calls it."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory.only("pieces")
        for batch in batches:
            found = encode_texts(batch.tolist(), place())
            yield pd.Series([np.frombuffer(b, "<i4") for b in found], dtype=object)

    return ids(F.col(f"`{text_column}`"))


def decode(place: Callable[[], str], ids_column: str = "ids") -> Column:
    """Column of string: the text of an array of ids; null for null."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [None if x is None else decode_ids(np.asarray(x, np.int64), place()) for x in batch], dtype=object
            )

    return text(F.col(f"`{ids_column}`"))


def round_trip(place: Callable[[], str], text_column: str = "text") -> Column:
    """Column of struct(n_ids, ids_crc32, decoded_sha256): a text's pieces by ``encode``, as
    CRC-32 of the ids in little-endian unsigned 32-bit, and SHA-256 of what ``decode`` makes of
    them. One pass in one worker, in which no more than a few texts' ids are held."""

    @F.pandas_udf("n_ids long, ids_crc32 long, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory.only("pieces")
        path = place()
        for batch in batches:
            size, crc, sha = [], [], []
            for a, b in chunks(batch):
                for ids in encode_texts(batch.iloc[a:b].tolist(), path):
                    size.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    text = decode_ids(np.frombuffer(ids, "<u4"), path)
                    sha.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
            yield pd.DataFrame(
                {"n_ids": np.array(size, np.int64), "ids_crc32": np.array(crc, np.int64), "decoded_sha256": pd.Series(sha, dtype=object)}
            )
            memory.give_back()

    # Not to be taken apart by the optimiser: each field would run it once more.
    return digests.asNondeterministic()(F.col(f"`{text_column}`"))
