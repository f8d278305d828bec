"""Rows whose value lies in a range: matched by bins, without comparing every pair."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import settle

#: A level's bins are this many of the level below, as a power of two; with so many levels any
#: range of longs is a few dozen bins.
STEP_BITS = 4
LEVELS = 16


@dataclass(frozen=True)
class Within:
    """A table column that lies between two columns of the ranges, bounds included. Dates,
    zone-free timestamps and numbers; a NULL or non-finite value lies in no range, and a range
    with a NULL or non-finite bound or an upper one below the lower holds nothing."""

    column: str
    low: str
    high: str

    def test(self) -> Column:
        """The exact test, over the aliases ``t`` (table) and ``s`` (ranges)."""
        value = F.col(f"t.{self.column}")
        return (F.col(f"s.{self.low}") <= value) & (value <= F.col(f"s.{self.high}"))


def in_levels(
    rows: DataFrame, ranges: DataFrame, within: Within, condition: Column | None = None
) -> tuple[DataFrame, Iterator[tuple[DataFrame, Column]]]:
    """``rows`` with a column ``__bin``, and per level the bins of the ranges with the test under
    which a row (alias ``t``) matches one (alias ``s``).

    Bins are as wide as the middle range is long. A range is listed under the bins its ends fall
    into; those in between are covered by bins of higher levels, each of 16 bins of the level
    below: some thirty a level, however long the range. A test is an equality of bins, which
    Spark hashes, and the exact comparison.
    """
    kind = rows.schema[within.column].dataType
    low, high = _position(F.col(within.low), kind), _position(F.col(within.high), kind)
    proper = ranges.filter((F.col(within.low) <= F.col(within.high)) & low.isNotNull() & high.isNotNull())
    middle = proper.agg(F.percentile_approx(high - low, 0.5)).first()[0]
    width = float(middle) if middle else 1.0
    listed = settle(
        proper.withColumn("__at", F.explode(_cover(_bin(low, width), _bin(high, width)))).select(
            *ranges.columns, "__at.*"
        )
    )
    binned = rows.withColumn("__bin", _bin(_position(F.col(within.column), kind), width))
    found = sorted(r["level"] for r in listed.select("level").distinct().collect())  # LEVELS at most

    def levels() -> Iterator[tuple[DataFrame, Column]]:
        for level in found:
            test = F.shiftright("t.__bin", STEP_BITS * level) == F.col("s.bin")
            test = test & within.test()
            yield listed.filter(F.col("level") == level).drop("level"), test if condition is None else test & condition

    return binned, levels()


def _position(value: Column, kind: T.DataType) -> Column:
    """A number that grows with the value; NULL where there is none."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value.cast("date")).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value.cast("timestamp_ntz")).cast("double")
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"no ranges over {kind.simpleString()}")
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def _bin(position: Column, width: float) -> Column:
    return F.floor(position / F.lit(width)).cast("long")


def _cover(first: Column, last: Column) -> Column:
    """(level, bin) of the ends, and of blocks that cover exactly the bins between them."""

    def inner(level: int) -> tuple[Column, Column]:
        """Blocks of a level that lie between the ends as a whole: from, and up to."""
        bits = STEP_BITS * level
        return F.shiftright(first + (1 << bits), bits), F.shiftright(last, bits)

    pieces = [F.array_distinct(F.array(_piece(0, first), _piece(0, last)))]
    for level in range(LEVELS):
        begin, end = inner(level)
        if level + 1 == LEVELS:
            pieces.append(_blocks(level, begin, end))
            break
        # Those that a block of the next level covers are left to it.
        above, below = inner(level + 1)
        whole = above < below
        pieces.append(_blocks(level, begin, F.when(whole, F.shiftleft(above, STEP_BITS)).otherwise(end)))
        pieces.append(F.when(whole, _blocks(level, F.shiftleft(below, STEP_BITS), end)).otherwise(_none()))
    return F.concat(*pieces)


def _blocks(level: int, begin: Column, end: Column) -> Column:
    listed = F.transform(F.sequence(begin, end - 1), lambda b: _piece(level, b))
    return F.when(begin < end, listed).otherwise(_none())


def _piece(level: int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), number.alias("bin"))


def _none() -> Column:
    return F.array().cast("array<struct<level:int,bin:bigint>>")
