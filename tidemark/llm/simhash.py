"""Near-duplicates by SimHash: a byte-position index with count filtering."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.components import components
from tidemark.llm.frames import packed_row, settle

BYTES = 8
#: Postings of a key that are compared directly, in blocks; larger ones meet at midpoints.
DIRECT = 4096
#: Shingle hashes that are added up at once.
AT_ONCE = 1 << 16


def _fingerprint(text: str | None, shingle: int, seed: int) -> int:
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(line, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        edges = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())
        hashes = [digest(line[a:b], seed) for a, b in edges] if shingle > 1 else [digest(w, seed) for w in words]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for i in range(0, len(values), AT_ONCE):
        bits = np.unpackbits(values[i : i + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values), bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text_column: str = "text", shingle: int = 4, seed: int = 42) -> Column:
    """SimHash of a whole text as a long: A-Z lower-cased, words between ASCII white space,
    ``shingle``-word shingles with repeats, XXH64 of each. A shorter text is one shingle; a
    null text or one without words has fingerprint zero."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory.only()
        for batch in batches:
            yield pd.Series([_fingerprint(t, shingle, seed) for t in batch], dtype="int64")

    return hashed(F.col(f"`{text_column}`"))


def _covering_sets(needed: int) -> list[tuple[int, ...]]:
    """Sets of 3 byte positions (2 or 1 when ``needed`` is that small), such that any
    ``needed`` positions contain one: what ``needed`` equal bytes surely share.

    For four equal bytes, positions fall into three classes by their remainder modulo 3. Of
    any four positions, three lie in one class, or two in one and one in the next: 20 sets
    instead of all 56. Other numbers take all sets.
    """
    every = list(itertools.combinations(range(BYTES), min(3, needed)))
    if needed != 4:
        return every
    patterns = {(c, c, c) for c in range(3)} | {tuple(sorted((c, c, (c + 1) % 3))) for c in range(3)}
    return [s for s in every if tuple(sorted(p % 3 for p in s)) in patterns]


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def links(fingerprints: DataFrame, max_bits: int = 4, direct: int = DIRECT) -> DataFrame:
    """Edges (a, b) that join exactly the distinct values of column ``fp`` which lie within
    ``max_bits`` differing bits of each other, directly or over further links.

    Values that differ in ``max_bits`` bits share at least 8 - max_bits bytes at their
    positions. So each is listed under the bytes it has at sets of positions, one of which
    such a pair must share. Under each key, the equal positional bytes of pairs are tallied,
    pairs with the guaranteed number kept, and their differing bits counted. A key gives a
    spanning forest of its links, not all pairs. Keys with more than ``direct`` values are
    not compared by pairs: two values within ``max_bits`` have a midpoint within half of it of
    both, so each value is listed under its near midpoints and those listed together are linked.
    """
    needed = BYTES - max_bits
    if not 0 < needed <= BYTES or max_bits % 2:
        raise ValueError("max_bits is an even number below 8")
    sets = _covering_sets(needed)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(s))) for s in sets])
    postings = fingerprints.select("fp", F.posexplode(keys).alias("kind", "key"))
    counts = postings.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    busy = settle(postings.join(counts, ["kind", "key"]))

    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for members in batch["members"]:
                for x, y in _forest(np.asarray(members, np.int64), needed, max_bits):
                    a.append(x)
                    b.append(y)
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    small = (
        busy.filter(F.col("n") <= direct)
        .groupBy("kind", "key")
        .agg(F.collect_list("fp").alias("members"))
        .select("members")
        .mapInPandas(forests, "a long, b long")
    )
    # Values with the same key differ only in the other bytes, so midpoints do too.
    flips = fingerprints.sparkSession.createDataFrame(
        [(kind, _flips(s, max_bits // 2)) for kind, s in enumerate(sets)], "kind int, flips array<long>"
    )
    middle = (
        busy.filter(F.col("n") > direct)
        .join(F.broadcast(flips), "kind")
        .select("kind", "key", "fp", F.explode("flips").alias("flip"))
        .groupBy("kind", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("midpoint"))
        .agg(F.collect_list("fp").alias("members"))  # no more than there are flips
        .filter(F.size("members") > 1)
        .select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
    )
    return small.unionByName(middle).filter("a <> b").distinct()


def _flips(positions: tuple[int, ...], bits: int) -> list[int]:
    free = [8 * p + i for p in range(BYTES) if p not in positions for i in range(8)]
    values = [sum(1 << b for b in some) for n in range(bits + 1) for some in itertools.combinations(free, n)]
    return [v - (1 << 64) if v >= 1 << 63 else v for v in values]


def _forest(members: np.ndarray, needed: int, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that span each group of near values under one key."""
    left = members
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            value = frontier.pop()
            differ = left ^ value
            shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = shared >= needed
            near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                for other in found.tolist():
                    yield int(other), int(value)
                frontier.extend(found)


def clusters(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = 4,
    max_bits: int = 4,
    carry: bool = False,
) -> DataFrame:
    """Classes of documents whose fingerprints are linked, directly or through others.

    Returns one row per row of ``docs``: id, fp (long), component_id (least id of the class)
    and with ``carry`` the struct ``row`` and ``first`` (true for one row of each class, the
    one with the least id). Equal texts are one fingerprint from the first step on, so copies
    cost no pairs. A null id is not a least id unless the class has no other. An empty table
    gives no rows.
    """
    hashed = settle(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(f"`{id_column}`").alias("id"),
            fingerprint(text_column, shingle).alias("fp"),
            *([packed_row(docs).alias("row")] if carry else []),
        )
    )
    # Nulls last: (is null, id, row) in this order.
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("least")
    distinct = settle(hashed.groupBy("fp").agg(least))
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    classes = rooted.groupBy("root").agg(F.min("least").alias("least"))
    of_value = rooted.select("fp", "root").join(classes, "root").select("fp", "least")
    return hashed.join(of_value, "fp").select(
        F.col("id").alias(id_column),
        "fp",
        F.col("least.id").alias("component_id"),
        *(["row", (F.col("least.rid") == F.col("rid")).alias("first")] if carry else []),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; columns as they were."""
    found = clusters(docs, id_column, text_column, shingle=shingle, max_bits=max_bits, carry=True)
    return found.filter("first").select("row.*")
