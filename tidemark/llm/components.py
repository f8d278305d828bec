"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the least node that
    can be reached.

    Alternates two steps on the edge list until it is a star around each root: every node
    tells its larger neighbours, then its smaller ones, of the least node it knows. Each step
    is one aggregate and one join, so a hub of any degree is spread over tasks, and the number
    of rounds grows with the logarithm of the longest chain. Each round's edges are written
    to the shared folder; a lost executor costs no earlier round. Self-edges are ignored;
    null nodes are not nodes.
    """
    edges = settle(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        edges = settle(_small_star(_large_star(edges)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.join(least, "a")
        .filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .unionByName(joined.select("a", F.col("m").alias("b")))
        .distinct()
    )
