"""Small helpers on frames that the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import settle

__all__ = ["documents", "join_groups", "packed_row", "settle", "tokenizer_file"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def packed_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names added beside it cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def tokenizer_file(name: str, folder: str | None = None) -> Callable[[], str]:
    """Where a tokenizer's file is, asked for on the machine that opens it."""

    def place() -> str:
        if folder is not None:
            return os.path.join(folder, name)
        import public_tokenizers

        return public_tokenizers.path(name)

    return place


def join_groups(rows: DataFrame, groups: DataFrame, on: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``groups`` by key ``on``; rows of other keys go.

    ``groups`` has a row per key, with the number of its rows in column ``size``. Keys that hold
    more than a thousandth of all rows are fewer than a thousand: those are broadcast, and their
    rows stay where they are. Rows of all other keys meet theirs in a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    often = F.col(size) > max(total // 1000, 1)
    hot = F.broadcast(groups.filter(often))
    rest = rows.join(hot.select(on), on, "left_anti").join(groups.filter(~often), on)
    return rows.join(hot, on).unionByName(rest)
