"""Merkle-tree fingerprints: sections, their paragraphs, and the paragraphs' sentences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import settle

#: Ids are ordered in slices of 2**SLICE_BITS values: no window sees more documents.
SLICE_BITS = 10
#: Hex digits that a node has in a fingerprint; the root has all 64.
NODE = 8


def tree(text: Column) -> Column:
    """The leaves of a text: sections (between blank lines) of paragraphs (lines) of sentences
    (up to a full stop and space), each as SHA-256 in hex. Null counts as empty."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n", -1),
        lambda section: F.transform(
            F.split(section, "\n", -1),
            lambda paragraph: F.transform(F.split(paragraph, r"\. ", -1), lambda s: F.sha2(s, 256)),
        ),
    )


def _above(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ","), 256)


def fingerprint(leaves: Column) -> Column:
    """Root of the tree, a colon, and the first hex digits of all nodes: root, sections,
    paragraphs, sentences. Equal for equal texts; the root differs for different ones."""
    paragraphs = F.transform(leaves, lambda section: F.transform(section, _above))

    def joined(paragraphs: Column) -> Column:
        sections = F.transform(paragraphs, _above)
        root = _above(sections)
        nodes = F.concat(F.array(root), sections, F.flatten(paragraphs), F.flatten(F.flatten(leaves)))
        short = F.transform(nodes, lambda n: F.substring(n, 1, NODE))
        return F.concat(root, F.lit(":"), F.array_join(short, ""))

    # A one-element array gives the paragraphs' hashes a name, so they are computed once.
    return F.element_at(F.transform(F.array(paragraphs), joined), 1)


def likeness(one: Column, other: Column) -> Column:
    """Share of the trees' nodes that two fingerprints have in common (Dice), 0 to 1; 1 for
    equal fingerprints."""

    def nodes(print_: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.substring(print_, 66, 1 << 30), F.lit(f".{{{NODE}}}"), F.lit(0)))

    a, b = nodes(one), nodes(other)
    dice = 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))
    return F.when(one == other, F.lit(1.0)).otherwise(dice)


def edits(one: Column, other: Column) -> Column:
    """Paths of the paragraphs in which two ``tree`` columns differ, as (section, paragraph)
    from 0: below a pair of equal branches nothing is reported."""
    hashes = [F.transform(t, lambda s: F.transform(s, _above)) for t in (one, other)]

    def differing(a: Column, b: Column, section: Column) -> Column:
        pairs = F.arrays_zip(
            F.coalesce(a, F.array().cast("array<string>")).alias("a"),
            F.coalesce(b, F.array().cast("array<string>")).alias("b"),
        )
        numbered = F.transform(
            pairs, lambda p, i: F.when(~p["a"].eqNullSafe(p["b"]), F.struct(section.alias("section"), i.alias("paragraph")))
        )
        return F.filter(numbered, lambda x: x.isNotNull())

    branches = F.arrays_zip(hashes[0].alias("a"), hashes[1].alias("b"))
    return F.flatten(F.transform(branches, lambda p, i: differing(p["a"], p["b"], i)))


def following(values: DataFrame) -> DataFrame:
    """(v, next) for the distinct longs ``v``: the next smaller one, and for the smallest the
    largest.

    Values are cut into slices of 2**SLICE_BITS; the last of a slice is followed by the first
    of the next slice that is not empty, which the same step finds on the slices' numbers. So
    no window is larger than a slice, whatever the values are.
    """
    if values.count() <= 1 << SLICE_BITS:
        # Few enough for one window; the frame over all rows gives the largest.
        whole = Window.partitionBy().orderBy(F.desc("v"))
        every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return values.select("v", F.coalesce(F.lead("v").over(whole), F.max("v").over(every)).alias("next"))
    sliced = values.withColumn("slice", F.shiftright("v", SLICE_BITS))
    heads = settle(sliced.groupBy("slice").agg(F.max("v").alias("head")))
    after = following(heads.select(F.col("slice").alias("v"))).join(
        heads.select(F.col("slice").alias("next"), "head"), "next"
    )
    inside = Window.partitionBy("slice").orderBy(F.desc("v"))
    return (
        sliced.withColumn("inner", F.lead("v").over(inside))
        .join(after.select(F.col("v").alias("slice"), "head"), "slice")
        .select("v", F.coalesce("inner", "head").alias("next"))
    )


def with_next(rows: DataFrame, carry: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``carry(rows)`` with, as ``next``, the column ``value`` it adds of the row of the next
    smaller ``key``, and for the smallest key that of the largest; keys are distinct longs."""
    sliced = rows.withColumn("slice", F.shiftright("key", SLICE_BITS))
    inside = Window.partitionBy("slice").orderBy(F.desc("key"))
    stepped = carry(sliced).withColumns(
        {
            "inner": F.lead("value").over(inside),
            "tail": F.lead(F.lit(False), 1, True).over(inside),
        }
    )
    # One row a slice crosses to another: the last takes the value of the next slice's first.
    slices = settle(rows.groupBy(F.shiftright("key", SLICE_BITS).alias("v")).agg(F.max("key").alias("head")))
    after = following(slices.select("v"))
    heads = carry(rows.join(slices.select(F.col("head").alias("key"), F.col("v").alias("next")), "key"))
    across = after.join(heads, "next").select(
        F.col("v").alias("slice"), F.lit(True).alias("tail"), F.col("value").alias("outer")
    )
    joined = stepped.join(across, ["slice", "tail"], "left")
    following_value = F.when(F.col("tail"), F.col("outer")).otherwise(F.col("inner"))
    return joined.withColumn("next", following_value).drop("slice", "tail", "inner", "outer")


def _marked(rows: DataFrame) -> DataFrame:
    """``text`` packed with its fingerprint as ``value``."""
    return rows.withColumn("value", F.struct("text", fingerprint(tree(F.col("text"))).alias("mark"))).drop("text")


def edited_pairs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of whole texts, of their edited texts, and how alike they are.

    The edited text has the last half of the code points replaced by the first as many, or
    all, of the next document by descending id; the first follows the last. Ids are integers;
    a null id is last. Rows that share an id stand at one place: the least of their texts is
    what the document before them takes, and each is followed by the next smaller id. A null
    text is empty. A table of one document follows itself; an empty one gives no rows.
    """
    # The one value below all others; a table that uses it has null ids beside it.
    key = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), key.alias("key"), text.alias("text"))
    repeated = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"))
    if repeated.isEmpty():
        found = with_next(rows, _marked)
    else:
        several = rows.join(repeated, "key", "left_semi")
        one = several.groupBy("key").agg(F.first("id").alias("id"), F.min("text").alias("text"))
        single = rows.join(repeated, "key", "left_anti")
        steps = with_next(single.unionByName(one), _marked)
        alone = steps.join(repeated, "key", "left_anti")
        shared = _marked(several).join(steps.join(repeated, "key", "left_semi").select("key", "next"), "key")
        found = alone.unionByName(shared)
    size = F.length("value.text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("value.text"), F.lit(1), size - half),
        F.substring(F.col("next.text"), F.lit(1), half),
    )
    found = found.select(
        "id",
        size.cast("long").alias("n_chars"),
        edited.alias("edited"),
        F.col("value.mark").alias("fingerprint"),
        F.col("next.mark").alias("next_fingerprint"),
    ).withColumn("edited_fingerprint", fingerprint(tree(F.col("edited"))))
    return found.select(
        F.col("id").alias(id_column),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
