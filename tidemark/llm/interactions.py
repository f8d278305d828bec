"""Filter interaction audit: what each filter of a sequence removes, by relations of failing ids."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import reduce
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import join_groups, settle

#: Counts of a step, in the order of the result.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text without nulls: too few words (A), too many repeated ones
    (B), too many capitals (C), marks of code or tables (D)."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": count < 100,
        "B": 100 * distinct < 80 * count,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failing_ids(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The relation of all documents (rid, part, good, toxic) and, per filter, the stored table
    of the ``rid`` that fail it: ``text_filters``, and E, a text that a smaller id has as well.

    ``rid`` numbers rows, so repeated ids stay apart. A null text is empty, a null part the
    empty string. A null id is never smaller or larger than another, and has no labels. Of
    several labels of an id, one is enough for a flag.
    """
    content = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    typed = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"),
        content.alias("content"),
    )
    # Texts are equal when their digests are; the digest is all that moves of a text.
    judged = settle(
        typed.select(
            F.monotonically_increasing_id().alias("rid"),
            "id",
            "part",
            F.unhex(F.sha2(F.col("content").cast("binary"), 256)).alias("digest"),
            *[fails.alias(name) for name, fails in text_filters(F.col("content")).items()],
        )
    )
    flags = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    known = judged.select("rid", "id", "part").join(flags, "id", "left")
    everything = settle(known.select("rid", "part", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]))
    tables = {name: settle(judged.filter(name).select("rid")) for name in ("A", "B", "C", "D")}
    tables["E"] = settle(_later_copies(judged))
    return everything, tables


def _later_copies(judged: DataFrame) -> DataFrame:
    rows = judged.select("rid", "id", "digest")
    same = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    repeated = settle(same.filter("n > 1"))
    return join_groups(rows, repeated, "digest", "n").filter("id > first").select("rid")


def after_prefixes(rows: DataFrame, tables: Mapping[int, DataFrame]) -> DataFrame:
    """``rows`` once for every set of filters that they survive, the set as sum of its bits in
    ``prefix``. ``tables`` has failing ids by bit.

    One left-anti join a filter: a row meets it with the filter's bit and without, and only
    with it can it be removed. All joins are on the same key, so rows move once, before they
    multiply. Survivors do not depend on the order of a prefix, so sets stand for all orders.
    """
    out = rows.withColumn("prefix", F.lit(0))
    for bit, ids in tables.items():
        both = out.withColumn("prefix", F.explode(F.array(F.col("prefix"), F.col("prefix") + bit)))
        applied = both["prefix"].bitwiseAND(F.lit(bit)) != 0
        out = both.join(ids.hint("shuffle_hash"), (both["rid"] == ids["rid"]) & applied, "left_anti")
    return out


def step_counts(everything: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(part, filter, prefix, rows, good, toxic): what filter number ``filter`` removes after
    the set ``prefix`` of others, and with filter -1 what is left after the set.

    Survivors are documents less the failing ids of each filter of the set (left-anti); what is
    removed are survivors among the ids that the filter fails (left-semi). Rows that fail no
    filter are counted once, not per set.
    """
    bits = {name: 1 << i for i, name in enumerate(tables)}
    failing = reduce(DataFrame.unionByName, tables.values())
    counted = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    ]

    def tally(rows: DataFrame, number: int) -> DataFrame:
        return rows.groupBy("part", F.lit(number).alias("filter"), "prefix").agg(*counted)

    some = everything.join(failing, "rid", "left_semi")
    left = [tally(after_prefixes(some, {bits[n]: t for n, t in tables.items()}), -1)]
    none = everything.join(failing, "rid", "left_anti")
    clean = none.withColumn("prefix", F.lit(-1))
    left.append(tally(clean, -1))
    for number, (name, ids) in enumerate(tables.items()):
        others = {bits[n]: t for n, t in tables.items() if n != name}
        left.append(tally(after_prefixes(everything.join(ids, "rid", "left_semi"), others), number))
    return reduce(DataFrame.unionByName, left)


def audit(everything: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step in it: part, filter_order, step and the
    COUNTS, zeros included. An empty table gives no rows.

    ``shapley`` is what the step's filter removes, summed over all orders: a set of s others
    precedes it in s! (n - s - 1)! of them. There are n! orders: n is meant to be small.
    """
    names = list(tables)
    n, spark = len(names), everything.sparkSession
    counts = settle(step_counts(everything, tables))
    parts = settle(everything.groupBy("part").agg(F.count(F.lit(1)).alias("documents")))
    pairs = [(f, s) for f in range(n) for s in range(1 << n) if not s >> f & 1]
    of_filter = _complete(parts, counts.filter("filter >= 0"), pairs)
    weight = _lookup(F.bit_count("prefix"), [factorial(s) * factorial(n - s - 1) for s in range(n)])
    per_filter = of_filter.groupBy("part", "filter").agg(
        F.max(F.when(F.col("prefix") == 0, F.col("rows"))).alias("fails"),
        F.max(F.when(F.bit_count("prefix") == n - 1, F.col("rows"))).alias("unique_fails"),
        F.sum(F.col("rows") * weight).alias("shapley"),
    )
    # Clean rows survive every set; they are listed under the set -1.
    clean = counts.filter("prefix = -1").select("part", F.col("rows").alias("clean"))
    after = _complete(parts, counts.filter("filter = -1 AND prefix >= 0"), [(-1, s) for s in range(1 << n)])
    after = after.join(clean, "part", "left").select(
        "part", F.col("prefix").alias("after"), (F.col("rows") + F.coalesce("clean", F.lit(0))).alias("kept")
    )
    steps = spark.createDataFrame(
        [
            ("".join(names[f] for f in order), step + 1, f, sum(1 << g for g in order[:step]), sum(1 << g for g in order[: step + 1]))
            for order in itertools.permutations(range(n))
            for step, f in enumerate(order)
        ],
        "filter_order string, step int, filter int, prefix int, after int",
    )
    return (
        of_filter.join(F.broadcast(steps), ["filter", "prefix"])  # n * n! rows, whatever the input
        .join(per_filter, ["part", "filter"])
        .join(after, ["part", "after"])
        .select(
            "part",
            "filter_order",
            "step",
            "kept",
            F.col("rows").alias("removed"),
            (F.col("fails") - F.col("rows")).alias("redundant"),
            "unique_fails",
            F.col("good").alias("good_lost"),
            F.col("toxic").alias("toxic_lost"),
            "shapley",
        )
    )


def _complete(parts: DataFrame, counts: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Every pair of filter and prefix for every part, with zeros where nothing was counted."""
    every = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(s).alias("prefix")) for f, s in pairs])
    grid = parts.select("part", F.explode(every).alias("pair")).select("part", "pair.*")
    return grid.join(counts, ["part", "filter", "prefix"], "left").fillna(0, ["rows", "good", "toxic"])


def _lookup(index: Column, values: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index.cast("int") + 1)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the filters A to E on ``docs`` (doc_id, text, lang)."""
    return audit(*failing_ids(docs, labels))
