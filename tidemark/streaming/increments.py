"""Raw files as a stream: each file feeds the same merge exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.load import publish_silver
from tidemark.plans.silver import SilverTable
from tidemark.sources.parted import PARTS


def follow_raw(
    spark: SparkSession,
    folder: str,
    schema: str,
    on_increment: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    files_per_increment: int | None = None,
) -> StreamingQuery:
    """Hand all files that are new since the last call to ``on_increment``, then stop.

    The checkpoint (a shared folder) takes the place of a high-water mark: a file that
    arrives late with old timestamps is loaded too. An increment that fails is handed out
    again, so ``on_increment`` must be repeatable, as a keyed merge is.
    """
    reader = spark.readStream.schema(schema)
    if files_per_increment is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_increment)
    return (
        reader.parquet(folder)
        .writeStream.foreachBatch(on_increment)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def silver_increment(
    name: str, schema: str, table: SilverTable, batch_id, now, *, parts: int = PARTS
) -> Callable[[DataFrame, int], None]:
    """An ``on_increment`` that merges raw rows into the silver table ``name``.

    ``batch_id`` and ``now`` are values for all increments, or functions of an increment's
    number. An increment rewrites the partitions that its keys fall into.
    """

    def merge_increment(raw: DataFrame, number: int) -> None:
        run = {
            "batch_id": batch_id(number) if callable(batch_id) else batch_id,
            "now": now(number) if callable(now) else now,
        }
        publish_silver(raw.sparkSession, name, schema, raw, table, parts=parts, **run)

    return merge_increment
