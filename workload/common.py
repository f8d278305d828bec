"""Shared input frames, run times and batch numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOW = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00")
BATCH = ("20240201000000000000000", "20240202000000000000000", "20240203000000000000000")
# Loads arrive in three increments, split at these marks.
MARK = ("1997-06-01 00:00:00", "1999-06-01 00:00:00")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str):
    return F.col(column).cast("string")


def portable(df: DataFrame, *counts: str) -> DataFrame:
    """Types that read the same from any engine: ids and dates as text, money as double,
    and so the ``counts`` that may be NULL."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double" if field.dataType.scale else "string")
        elif field.name in counts:
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def application_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON applications from orders."""
    orders = table(spark, folder, "orders")
    payload = F.struct(
        text("o_orderkey").alias("application_id"),
        text("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("application_date"),
        F.col("o_totalprice").alias("amount_requested"),
        F.col("o_orderpriority").alias("property_type"),
        F.lower("o_orderstatus").alias("status"),
    )
    return orders.select(
        text("o_orderkey").alias("application_id"),
        F.col("o_orderdate").alias("src_load_ts"),
        F.parse_json(F.to_json(payload)).alias("raw_json"),
    )


def payment_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON payments from lineitem; payment ids repeat, as reloaded records do."""
    items = table(spark, folder, "lineitem")
    payment_id = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"))
    payload = F.struct(
        payment_id.alias("payment_id"),
        text("l_orderkey").alias("application_id"),
        F.col("l_shipdate").cast("date").alias("payment_date"),
        F.col("l_extendedprice").alias("payment_amount"),
        F.col("l_linestatus").alias("payment_status"),
    )
    return items.select(
        payment_id.alias("payment_id"),
        F.col("l_shipdate").alias("src_load_ts"),
        F.parse_json(F.to_json(payload)).alias("raw_json"),
    )
