"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in the given order (pass descending columns for the latest).

    Rank and filter stay adjacent, so each map task keeps a single row per key before
    the shuffle: a key that owns a third of the table costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def assert_one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself; the job fails when a key occurs twice. At most two rows per key and task move."""
    window = Window.partitionBy(*keys).orderBy(*keys)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    message = F.concat(
        F.lit("duplicate key in merge source: "),
        F.to_json(F.struct(*[F.col(k) for k in keys])),
    )
    second = F.when(F.col("__rank") > 1, F.raise_error(message)).otherwise(F.lit(True))
    return ranked.filter(F.col("__rank") <= 2).filter(second.cast("boolean")).drop("__rank")
