"""Drift inside a payload: fields that a batch brings, lost, or brings in another type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import schema_drift

#: Numbers are one type here: how many digits the numbers of a batch have is no drift.
_NUMBER = r"decimal\([0-9]+,[0-9]+\)|bigint|double|float"
#: The type of a field that is null wherever it stands; it tells nothing of the field.
NOTHING = "void"
#: The type of a field whose values in one batch are of several types.
MIXED = "variant"


def payload_fields(raw: DataFrame, payload: str = "raw_json", model: str = "model_id") -> DataFrame:
    """(model_id, column_name, data_type): the top-level fields of Variant payloads, by model.

    The type is that of all values of the field together; an object or an array has its
    parts in it, so a change below the first level shows as another type. A payload that is
    NULL or no object has no fields. Fields fold on the map side: what is shuffled is a row
    per model and field of each task.
    """
    spark = raw.sparkSession
    objects = raw.filter(F.schema_of_variant(payload).startswith("OBJECT")).select(
        F.col(model).alias("model_id"), F.col(payload).alias("payload")
    )
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer()))
    kind = F.lower(F.schema_of_variant_agg("value"))
    return fields.groupBy("model_id", F.col("key").alias("column_name")).agg(
        F.regexp_replace(kind, _NUMBER, "number").alias("data_type")
    )


def payload_drift(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Fields of a batch against the known ones, both as ``payload_fields`` gives them.

    The rows are those of ``schema_drift``. A field that was only ever null on one side has
    no type there and so differs in none; a known field that no row of the batch has is
    missing in the source.
    """
    untold = (F.col("source_column_type") == NOTHING) | (F.col("target_column_type") == NOTHING)
    return schema_drift(batch, known).filter((F.col("diff_type") != "TYPE_MISMATCH") | ~untold)


def known_after(batch: DataFrame, known: DataFrame) -> DataFrame:
    """The known fields once a batch has been accepted: its types replace the known ones, but
    for fields that were only null in it; fields that it did not bring stay known."""
    told = batch.withColumnRenamed("data_type", "__type")
    return known.join(told, ["model_id", "column_name"], "full").select(
        "model_id",
        "column_name",
        F.coalesce(F.nullif(F.col("__type"), F.lit(NOTHING)), "data_type", "__type").alias("data_type"),
    )
