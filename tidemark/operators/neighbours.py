"""The next or previous value within a group, also when one group is very large.

A window runs each group in one task. That is right for ordinary groups. Rows of a group
that would not fit a task are dealt out by ranges of group and order instead: the window
runs per range, and the values at the ranges' edges are joined on. The ranges decide only
how work is spread, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators.sizing import row_bytes
from tidemark.sources.tables import settle

# What the rows of one group may take up in one task, by the size that their types have as
# a rule. Larger groups are cut into ranges of about half of it.
GROUP_BYTES = 512 * 2**20

# Groups are first counted together, by this many numbers.
FOLDS = 4096


@dataclass(frozen=True)
class HotGroups:
    """Groups that are too large for a task: the columns that name a group, the groups as
    (gid, n), and their number of rows. However many there are, all are in."""

    columns: tuple[str, ...]
    groups: DataFrame | None
    rows: int

    def __bool__(self) -> bool:
        return self.rows > 0


def group_rows(df: DataFrame) -> int:
    """How many rows like those of ``df`` a group may have."""
    return max(1, GROUP_BYTES // row_bytes(df))


def find_hot_groups(df: DataFrame, group: Sequence[str], min_rows: int) -> HotGroups:
    """All groups of at least ``min_rows``.

    Groups are counted by a hash of their columns, map-side first; two groups of one hash count
    as one, which may cut a group that did not need it. As many groups would move, they are
    first counted together by few numbers of that hash: a number with fewer rows than that has
    no large group, and as a rule none is left.
    """
    gid = F.xxhash64(*group)
    number = F.pmod(gid, F.lit(FOLDS)).cast("int")
    together = df.groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("n"))
    full = [r["number"] for r in together.filter(F.col("n") >= min_rows).collect()]  # FOLDS at most
    if not full:
        return HotGroups(tuple(group), None, 0)
    counts = df.filter(number.isin(full)).groupBy(gid.alias("gid")).agg(F.count(F.lit(1)).alias("n"))
    groups = settle(counts.filter(F.col("n") >= min_rows))
    return HotGroups(tuple(group), groups, groups.agg(F.sum("n")).first()[0] or 0)


def with_neighbour(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    *,
    back: bool = False,
    hot: HotGroups | None = None,
    among: Column | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add the next row's values (or the previous row's, ``back``) in the group's order.

    ``values`` maps a new column to the column it is read from. ``order`` must be a total
    order within the group for a result that does not depend on the run. ``hot`` names
    groups to cut, by some of the ``group`` columns; ``among`` limits that to the rows
    whose groups can be large at all. ``slice_rows`` is what a range aims at.
    """
    step = F.lag if back else F.lead

    def windowed(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(*order)
        return rows.withColumns({new: step(old).over(window) for new, old in values.items()})

    if not hot:
        return windowed(df)

    gid = F.xxhash64(*hot.columns)
    marked = df.withColumn("__gid", gid if among is None else F.when(among, gid))
    names = hot.groups.select(F.col("gid").alias("__gid"))
    columns = [*df.columns, *values]
    ordinary = windowed(marked.join(names, "__gid", "left_anti")).select(*columns)

    # Written with the number of the range, so that every later step sees the same ranges.
    ranges = -(-hot.rows // (slice_rows or max(1, group_rows(df) // 2)))
    large = marked.join(names, "__gid", "left_semi").select(*df.columns)
    sliced = settle(
        large.repartitionByRange(ranges, *group, *order).withColumn("__slice", F.spark_partition_id())
    )
    # The row a neighbouring range looks at: its first one, or its last one going back.
    edge_of = F.max_by if back else F.min_by
    rank = F.struct(*[F.col(c) for c in order])
    carried = F.struct(*[F.col(old).alias(new) for new, old in values.items()])
    edges = sliced.groupBy(*group, "__slice").agg(edge_of(carried, rank).alias("__edge"))
    # A group has as many rows here as it has ranges.
    across = Window.partitionBy(*group).orderBy("__slice")
    edges = edges.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
        F.col("__slice").alias("__eslice"),
        step("__edge").over(across).alias("__edge"),
    )
    same = F.col("__slice") == F.col("__eslice")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))

    inside = Window.partitionBy(*group, "__slice").orderBy(*order)
    stepped = sliced.withColumns(
        {
            **{f"__in_{new}": step(old).over(inside) for new, old in values.items()},
            "__inner": step(F.lit(True)).over(inside),
        }
    )
    joined = stepped.join(edges, same, "left").select(
        *df.columns,
        *[
            F.when(F.col("__inner"), F.col(f"__in_{new}")).otherwise(F.col(f"__edge.{new}")).alias(new)
            for new in values
        ],
    )
    return ordinary.unionByName(joined)
