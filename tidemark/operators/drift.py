"""Schema drift between source and target column lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import batch_number, moment
from tidemark.sources.tables import settle

# Audit columns that are not compared.
IGNORED_COLUMNS = ("src_load_ts", "batch_id", "etl_load_ts", "etl_updt_ts")

DRIFT_KEYS = ["model_id", "model_grp", "pipeline_name", "batch_id"]


def table_columns(df: DataFrame, model_id: str) -> DataFrame:
    """(model_id, column_name, data_type) of a table's schema."""
    rows = [
        F.struct(
            F.lit(model_id).alias("model_id"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for f in df.schema.fields
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def schema_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that differ in type or exist on one side only, for many models at once.

    Both sides hold (model_id, column_name, data_type) with one row per column. Names and
    types are compared in lower case; one full join finds all three kinds of drift. A
    model without any source row, or any target row, is compared like the others.
    """
    joined = _side(source, "source_column_type").join(
        _side(target, "target_column_type"), ["model_id", "column_name"], "full"
    )
    old, new = F.col("target_column_type"), F.col("source_column_type")
    kind = (
        F.when(old.isNull(), F.lit("MISSING_IN_TARGET"))
        .when(new.isNull(), F.lit("MISSING_IN_SOURCE"))
        .when(old != new, F.lit("TYPE_MISMATCH"))
    )
    return joined.withColumn("diff_type", kind).filter(F.col("diff_type").isNotNull())


def record_drift(
    log: DataFrame,
    drift: DataFrame,
    *,
    model_grp: Column,
    pipeline_name: Column,
    source_table: Column,
    target_table: Column,
    batch_id,
    now,
    checked: DataFrame,
) -> DataFrame:
    """The drift log with this batch's rows replaced.

    ``checked`` lists the compared models (model_id): their earlier rows of the batch go
    even where no drift is left.
    """
    tags = {
        "model_grp": model_grp,
        "pipeline_name": pipeline_name,
        "batch_id": batch_number(batch_id),
    }
    rows = drift.withColumns(
        {
            **tags,
            "source_table": source_table,
            "target_table": target_table,
            "etl_load_ts": moment(now),
            "etl_updt_ts": moment(now),
        }
    )
    groups = settle(checked.withColumns(tags).select(*DRIFT_KEYS).distinct())
    kept = log.join(groups, DRIFT_KEYS, "left_anti").select(*log.columns)
    return kept.unionByName(rows.select(*log.columns))


def _side(columns: DataFrame, type_name: str) -> DataFrame:
    name = F.lower("column_name")
    return columns.filter(~name.isin(*IGNORED_COLUMNS)).select(
        "model_id", name.alias("column_name"), F.lower("data_type").alias(type_name)
    )
