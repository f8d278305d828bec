"""Size checks that pick between plans. Each plan is exact: a bad estimate costs time only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tidemark.sources.schemas import HASHES

_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate for ``df``; None where the session hides it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def input_bytes(df: DataFrame) -> int | None:
    """The size of all tables that ``df`` reads; joins in between do not inflate it."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(
            int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())
        )
    except AttributeError:
        return None


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; -1 when broadcasts are off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([bkmgt]?)b?\s*", text.lower()).groups()
    return int(number) * _UNITS[unit]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df``, and its rows do fit the threshold in memory."""
    return _planned_to_fit(df) and df.count() * joined_bytes(df) <= broadcast_limit(df)


def small_side(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is broadcast only where its rows do fit.

    Spark's estimate is of bytes in compressed files, cut down by what a projection leaves out
    at the types' usual sizes. What the driver has to hold of a key column may be a hundred
    times as much, so where the estimate fits and the rows do not, the sides are merged.
    """
    if not _planned_to_fit(df) or df.count() * joined_bytes(df) <= broadcast_limit(df):
        return df
    return df.hint("merge")


def _planned_to_fit(df: DataFrame) -> bool:
    size = planned_bytes(df)
    return size is not None and size <= broadcast_limit(df)


def joined_bytes(df: DataFrame) -> int:
    """What a row takes up in a join's table: its types' usual sizes, hashes at their length, and
    its place there."""
    return 32 + row_bytes(df) + 44 * sum(c in HASHES for c in df.columns)


def row_bytes(df: DataFrame) -> int:
    """What a row takes up as a rule, by its types: Spark's own default sizes."""
    try:
        return max(8, int(df._jdf.schema().defaultSize()))
    except AttributeError:
        return 64 * max(1, len(df.columns))
