"""Best-fit packing of documents into sequences, certified by dual-feasible functions."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.frames import settle
from tidemark.llm.tokens import word_ids

#: Sequences' worth of tokens that a partition packs, and partitions that exchange documents.
PARTITION_SEQUENCES, EXCHANGE = 512, 16
#: Sequences that a partition above its bound offers for exchange, at most; others a quarter.
OFFERED = 128
#: Pieces that a worker hands over at once; with their ids they take 4 MB at most.
PIECES_AT_ONCE = 512
#: Values of k that the bound by rounding tries.
ROUNDINGS = 40


def pieces_of(
    docs: DataFrame,
    place: Callable[[], str],
    id_column: str,
    text_column: str,
    capacity: int,
    end_id: int,
    with_ids: bool,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): token ids of whole texts, an end id after
    each, cut only where a document is longer than a sequence."""
    source = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory.only("word ids")
        for batch in batches:
            ids_of_rows = batch["id"].to_numpy(object)
            row, piece, start, length, crc, ids = [], [], [], [], [], []

            def gathered() -> pd.DataFrame:
                out = {
                    "id": pd.Series(ids_of_rows[row], dtype=object),
                    "piece": np.array(piece, np.int32),
                    "start": np.array(start, np.int64),
                    "length": np.array(length, np.int64),
                    "ids_crc32": np.array(crc, np.int64),
                }
                return pd.DataFrame(out | ({"ids": pd.Series(ids, dtype=object)} if with_ids else {}))

            for i, found in enumerate(word_ids(batch["text"].tolist(), place)):
                found = memoryview(found + end)
                for k, at in enumerate(range(0, len(found), 4 * capacity)):
                    part = found[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    if len(row) == PIECES_AT_ONCE:
                        yield gathered()
                        row, piece, start, length, crc, ids = [], [], [], [], [], []
            yield gathered()

    # As text, an id keeps all digits beside nulls.
    rows = docs.select(
        F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").alias("text")
    )
    schema = "id string, piece int, start long, length long, ids_crc32 long"
    pieces = rows.mapInPandas(cut, schema + (", ids array<int>" if with_ids else ""))
    return pieces.withColumn("id", F.col("id").cast(source))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that no packing of ``sizes`` can do without.

    The best of three families of dual-feasible functions: sizes as they are; sizes where
    those above capacity - t count as whole and those below t as nothing, for every t; and
    sizes rounded down to multiples of 1/k of a little less than the capacity.
    """
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    return bound_of_counts(counts, capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` from the number of documents of each size 0..capacity."""
    size = np.arange(capacity + 1)
    best = -(-int((counts * size).sum()) // capacity)
    above = np.cumsum(counts[::-1])[::-1]  # documents of at least a size
    weight = np.cumsum((counts * size)[::-1])[::-1]
    for t in range(1, capacity // 2 + 1):
        whole = int(above[capacity - t + 1]) if t >= 1 else 0
        middle = int(weight[t] - weight[capacity - t + 1])
        best = max(best, whole + -(-middle // capacity))
    half = capacity // 2
    large = int(above[half + 1])  # no two of these share a sequence
    best = max(best, large)
    for k in range(2, ROUNDINGS + 1):
        scaled = size * (k + 1)
        # A size that is an exact multiple keeps its value; others are rounded down to 1/k.
        exact = scaled % capacity == 0
        value = np.where(exact, size * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size, largest first, each into the fullest bin that still takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    free_set, used = 0, 0  # bit r: some bin has r free
    for i in order.tolist():
        size = int(sizes[i])
        fits = free_set >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                free_set &= ~(1 << room)
        else:
            room, b = capacity, used
            used += 1
        bins[i] = b
        if left := room - size:
            open_at[left].append(b)
            free_set |= 1 << left
    return bins


def _packed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One partition: packed anew where that takes fewer sequences than before, its gap to the
    bound, and the sequences it offers for exchange."""
    sizes = group["length"].to_numpy(np.int64)
    before = group["sequence_id"].to_numpy(np.int64)
    old, old_bin = np.unique(before, return_inverse=True)
    fresh = best_fit(sizes, capacity)
    if before[0] < 0 or fresh.max() + 1 < len(old):
        # A document belongs to one partition at a time: the least row of a bin names it.
        rows = group["rid"].to_numpy(np.int64)
        first = np.full(fresh.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, fresh, rows)
        bins, names = fresh, first
    else:
        bins, names = old_bin, old
    fill = np.bincount(bins, sizes).astype(np.int64)
    gap = len(fill) - lower_bound(sizes, capacity)
    # The emptiest sequences, more of them where the bound says that some can be saved here.
    offered = np.zeros(len(fill), bool)
    offered[np.argsort(fill, kind="stable")[: OFFERED if gap else OFFERED // 4]] = True
    offered &= fill < capacity
    return pd.DataFrame(
        {
            "rid": group["rid"].to_numpy(),
            "length": sizes,
            "sequence_id": names[bins],
            "grp": group["grp"].to_numpy() // EXCHANGE,
            "offered": offered[bins],
            "gap": gap,
        }
    )


def pack(
    docs: DataFrame,
    place: Callable[[], str],
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Whole documents as token pieces, placed into as few sequences as can be found.

    Returns per piece id, piece, start, length, ids_crc32, sequence_id, offset (gapless from 0
    within a sequence) and with ``with_ids`` the ids. Pieces are dealt evenly to partitions,
    which pack by best fit decreasing and compare with a lower bound. Each then offers its
    emptiest sequences, more of them where it is above its bound; sixteen partitions' offers are packed together, and so on until one partition is left. A new packing replaces
    the old one only if it is smaller. A null text is a document of the end id alone; equal
    rows are packed each; an empty table gives no rows.
    """
    pieces = settle(
        pieces_of(docs, place, id_column, text_column, capacity, end_id, with_ids).withColumn(
            "rid", F.monotonically_increasing_id()
        )
    )
    short = pieces.filter(F.col("length") < capacity)
    total = short.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (capacity * PARTITION_SEQUENCES)))
    current = short.select(
        "rid",
        "length",
        F.lit(-1).cast("long").alias("sequence_id"),
        F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("long").alias("grp"),
    )
    schema = "rid long, length long, sequence_id long, grp long, offered boolean, gap int"
    settled = []
    while True:

        def place_group(group: pd.DataFrame) -> pd.DataFrame:
            return _packed(group, capacity)

        done = settle(current.groupBy("grp").applyInPandas(place_group, schema))
        last = groups <= 1
        settled.append(done if last else done.filter(~F.col("offered")))
        if last:
            break
        current = done.filter("offered").select("rid", "length", "sequence_id", "grp")
        groups = -(-groups // EXCHANGE)
    placed = settled[0]
    for more in settled[1:]:
        placed = placed.unionByName(more)

    within = Window.partitionBy("sequence_id").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        "rid",
        "sequence_id",
        F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long").alias("offset"),
    )
    columns = ["piece", "start", "length", "ids_crc32"]
    ids = ["ids"] if with_ids else []
    whole = pieces.filter(F.col("length") == capacity).select(
        F.col("id").alias(id_column), *columns, F.col("rid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *ids
    )
    part = short.join(placed, "rid").select(
        F.col("id").alias(id_column), *columns, "sequence_id", "offset", *ids
    )
    return part.unionByName(whole)


def certified_bound(packed: DataFrame, capacity: int = 2048) -> int:
    """A lower bound on the sequences of any packing of these pieces, from the number of pieces
    of each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in packed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    return bound_of_counts(counts, capacity) if counts.any() else 0
