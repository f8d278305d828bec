"""Exact deduplication by distributed radix partitioning from the first byte on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed_row, settle

#: Bytes that the rounds split by. Each round reads further bytes of what is still grouped;
#: digits widen, so that a long text takes few rounds.
FIRST, WIDER, WIDEST = 64, 16, 1 << 20


def duplicate_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, carry: bool = False
) -> DataFrame:
    """Groups of byte-equal texts: one row per row of ``docs``.

    Documents are split by their first 64 bytes, then groups by their next 960, and so on,
    until a group has one document or has ended. Groups are counted with map-side sums and
    the counts joined back, so a group of any size is spread over tasks; only documents that
    still share all bytes read so far go into the next round. No digest decides equality.

    Returns id, keep_id (largest id of the group), group_size, kept, text_sha256, and with
    ``carry`` the row itself as struct ``row``. A null text counts as empty, a null id as the
    smallest. Of rows that repeat both id and text one is kept. An empty table gives no rows.
    """
    content = F.encode(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        content.alias("rest"),
        *([packed_row(docs).alias("row")] if carry else []),
    ).withColumn("digit", F.substring("rest", 1, FIRST))
    shared = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Row numbers are written once: all later rounds see the same ones.
    first = settle(
        rows.join(shared, "digit", "left").select(
            F.monotonically_increasing_id().alias("rid"),
            "id",
            F.col("n").isNull().alias("alone"),
            F.when(F.col("n").isNotNull(), F.col("digit")).alias("gid"),
            F.when(F.col("n").isNotNull(), F.expr(f"substring(rest, {FIRST + 1})")).alias("rest"),
            F.sha2("rest", 256).alias("text_sha256"),
            *(["row"] if carry else []),
        )
    )
    live = first.filter(~F.col("alone")).select("rid", "id", "gid", "rest")
    grouped, width = None, FIRST * (WIDER - 1)
    while not live.isEmpty():
        live, ended = _round(live, width)
        grouped = ended if grouped is None else grouped.unionByName(ended)
        width = min(width * WIDER, WIDEST)
    kept = ["row"] if carry else []
    result = first.filter("alone").select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        *kept,
    )
    if grouped is not None:
        several = first.filter(~F.col("alone")).join(grouped, "rid")
        result = result.unionByName(
            several.select(
                "id",
                F.col("keep.id").alias("keep_id"),
                F.col("n").alias("group_size"),
                (F.col("keep.rid") == F.col("rid")).alias("kept"),
                "text_sha256",
                *kept,
            )
        )
    return result.withColumnRenamed("id", id_column)


def _round(live: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Split groups by their next ``width`` bytes: what goes on, and what is decided."""
    digits = live.withColumn("digit", F.substring("rest", 1, width))
    groups = digits.groupBy("gid", "digit").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rid").alias("next"),
        F.max(F.struct("id", "rid")).alias("keep"),
    )
    over = (F.col("n") == 1) | (F.length("digit") < width)
    split = settle(
        digits.join(groups, ["gid", "digit"]).select(
            "rid",
            "id",
            F.col("next").alias("gid"),
            F.when(~over, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            "n",
            "keep",
            over.alias("over"),
        )
    )
    return (
        split.filter(~F.col("over")).select("rid", "id", "gid", "rest"),
        split.filter("over").select("rid", "n", "keep"),
    )


def drop_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without all but one of equal texts; columns as they were."""
    kept = duplicate_groups(docs, id_column, text_column, carry=True).filter("kept")
    return kept.select("row.*")
