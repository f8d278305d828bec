"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle of pre-tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.tokens import byte_counts, byte_pieces, plain, tokenizer

#: The broadcast table holds at most this many pre-tokens, the most frequent ones of at most
#: SAMPLE documents. It only saves time: a pre-token that is not in it is encoded.
FREQUENT, SAMPLE = 50_000, 3_000
#: Pre-tokens that a task of the sample reports.
REPORTED = 200_000


def frequent_lengths(
    docs: DataFrame, id_column: str, text_column: str, place: Callable[[], str]
) -> dict[str, int]:
    """Lengths of frequent pre-tokens, from a sample by hash of the id."""
    rank = F.xxhash64(F.col(f"`{id_column}`").cast("string"))
    ids = docs.select(rank.alias("rank")).distinct().orderBy("rank").limit(SAMPLE)
    sample = docs.select(F.col(f"`{text_column}`").alias("text"), rank.alias("rank"))
    sample = sample.join(F.broadcast(ids), "rank", "left_semi").select("text")

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                if text and plain(text):
                    counts.update(p for p in byte_pieces(text) if len(p) <= 32)
        if counts:
            pieces, numbers = zip(*counts.most_common(REPORTED))
            yield pd.DataFrame({"piece": pieces, "n": numbers})

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library = tokenizer(place)[1]
        for batch in batches:
            found = library.encode_batch_fast(batch["piece"].tolist(), add_special_tokens=False)
            yield pd.DataFrame({"piece": batch["piece"], "length": [len(e.ids) for e in found]})

    top = (
        sample.mapInPandas(tally, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(FREQUENT)
        .select("piece")
    )
    return {r["piece"]: r["length"] for r in top.mapInPandas(measure, "piece string, length int").collect()}


def count_tokens(
    docs: DataFrame,
    place: Callable[[], str],
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit of whole texts; columns of these
    names are replaced.

    ``place`` names the file of a byte-level tokenizer on the machine that calls it. Counts
    are the library's for every text: frequent pre-tokens are looked up in a broadcast table,
    others in the worker's cache, which the library fills; texts that need the library's own
    character tables go to it whole. A null text counts as empty.
    """
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_lengths(docs, id_column, text_column, place)
    )

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory.only("byte counts")
        for batch in batches:
            yield pd.Series(byte_counts(batch.tolist(), place, table.value), dtype="int64")

    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": lengths(text)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
