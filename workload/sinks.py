"""Writing tables: new state, appended rows, replaced partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.times import moment
from tidemark.sources.tables import (
    append,
    drop,
    publish,
    read,
    replace_partitions,
    settle,
    shared_folder,
)
from workload.common import MARK, table


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/tidemark/sinks/{uuid.uuid4().hex}"


def sink_publish(spark, folder):
    """A table's first state, and a second one made by reading the first."""
    name = f"sink_{uuid.uuid4().hex}"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    try:
        publish(orders, name, partition_by=["o_orderstatus"])
        double = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2)
        changed = F.coalesce(double, "o_totalprice")
        publish(read(spark, name).withColumn("o_totalprice", changed), name)
        return settle(read(spark, name))
    finally:
        drop(spark, name)


def sink_append(spark, folder):
    """Rows appended load by load."""
    where = _folder(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    late = F.col("o_orderdate") > moment(MARK[1])
    append(orders.filter(~late).withColumn("load_no", F.lit(1)), where)
    append(orders.filter(late).withColumn("load_no", F.lit(2)), where)
    return spark.read.parquet(where)


def sink_replace_partitions(spark, folder):
    """Batches by year; a rerun rewrites the years it holds and leaves the others."""
    where = _folder(spark)
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "'y'yyyy").alias("batch_id")
    )
    replace_partitions(orders, where, ["batch_id"])
    again = orders.filter((F.col("batch_id") >= "y1999") & (F.col("o_totalprice") > 1000))
    for _ in range(2):
        replace_partitions(again.withColumn("o_totalprice", F.lit(0.0)), where, ["batch_id"])
    return spark.read.parquet(where)


QUERIES = {
    "sink_publish": sink_publish,
    "sink_append": sink_append,
    "sink_replace_partitions": sink_replace_partitions,
}

SQL = {
    "sink_publish": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders""",
    "sink_append": f"""
SELECT o_orderkey, o_orderdate,
       CASE WHEN o_orderdate > TIMESTAMP '{MARK[1]}' THEN 2 ELSE 1 END AS load_no
FROM orders""",
    "sink_replace_partitions": """
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1999 THEN 0.0::DOUBLE ELSE o_totalprice END
         AS o_totalprice, 'y' || strftime(o_orderdate, '%Y') AS batch_id
FROM orders WHERE year(o_orderdate) < 1999 OR o_totalprice > 1000""",
}
