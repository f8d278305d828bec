"""Delete capture from a change archive, and hard and soft deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import batch_number, moment
from tidemark.operators.bands import Within
from tidemark.operators.deletes import (
    DELETE_EVENT,
    capture_deletes,
    count_deletes,
    delete_hard,
    delete_hard_logged,
    delete_soft,
    delete_soft_logged,
)
from workload.common import BATCH, NOW, portable, table, text

MODEL = "db.silver.customer_t"
VIEW = "DB.silver.Customer_V"


def _changes(spark, folder) -> DataFrame:
    """The events as a change archive; errors are deletes of the user's row."""
    events = table(spark, folder, "events")
    kind = F.when(F.col("event_type") == "error", F.lit(DELETE_EVENT)).otherwise(
        F.col("event_type")
    )
    return events.select(
        F.col("user_id").alias("primary_key__pk"),
        F.col("ts").alias("seen_at"),
        F.col("event_id").alias("least_significant_position"),
        kind.alias("event_type"),
        "value",
    )


def _log(spark, folder) -> DataFrame:
    """An earlier log: users with a large purchase, and another model's keys."""
    events = table(spark, folder, "events")
    large = events.filter((F.col("event_type") == "purchase") & (F.col("value") > 150))
    other = F.col("value") > 250
    return large.groupBy(
        F.when(other, F.lit("db.silver.other_t")).otherwise(F.lit(MODEL)).alias("model_id"),
        text("user_id").alias("pk"),
    ).agg(
        F.lit("old_group").alias("model_grp"),
        F.lit("old_run").alias("pipeline_name"),
        F.min("ts").alias("src_load_ts"),
        batch_number(BATCH[0]).alias("batch_id"),
        moment(NOW[0]).alias("etl_load_ts"),
        moment(NOW[0]).alias("etl_updt_ts"),
    )


def _captured(spark, folder) -> DataFrame:
    return capture_deletes(
        _changes(spark, folder),
        _log(spark, folder),
        model_id=F.lit(MODEL),
        model_grp=F.lit("silver"),
        pipeline_name=F.lit("nightly"),
        batch_id=BATCH[1],
        now=NOW[1],
    )


def cdc_delete_capture(spark, folder):
    return portable(_captured(spark, folder))


def _customers(spark, folder) -> DataFrame:
    """Customers as history rows; some are closed, some have no flag."""
    customers = table(spark, folder, "customer")
    balance = F.col("c_acctbal")
    return customers.select(
        "c_custkey",
        "c_name",
        F.when(balance > 1000, F.lit("Y")).when(balance > 0, F.lit("N")).alias("active_flg"),
        F.lit("Y").alias("reporting_flg"),
        F.when((balance > 0) & (balance <= 1000), moment(NOW[0])).alias("end_ts"),
        moment(NOW[1]).alias("etl_updt_ts"),
    )


def delete_impact_count(spark, folder):
    return count_deletes(_customers(spark, folder), _captured(spark, folder), MODEL, "c_custkey")


def delete_hard_by_log(spark, folder):
    return delete_hard_logged(
        _customers(spark, folder), _captured(spark, folder), VIEW, "c_custkey"
    )


def delete_soft_by_log(spark, folder):
    return delete_soft_logged(
        _customers(spark, folder), _captured(spark, folder), VIEW, "c_custkey"
    )


def _orders_history(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.nullif(text("o_custkey"), F.lit("7")).alias("cust_key"),
        F.col("o_orderdate").alias("start_ts"),
        F.when(F.col("o_orderstatus") == "O", F.lit("N")).otherwise("Y").alias("active_flg"),
        F.lit("Y").alias("reporting_flg"),
        moment(None).alias("end_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")).alias("etl_updt_ts"),
    )


def _returned(spark, folder) -> DataFrame:
    """Items sent back: the same order is listed many times."""
    items = table(spark, folder, "lineitem")
    return items.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_shipdate")


def _soon():
    """An order counts as withdrawn when an item came back soon after it."""
    return F.col("s.l_shipdate") <= F.col("t.start_ts") + F.expr("INTERVAL 40 DAYS")


def delete_hard_by_key(spark, folder):
    return delete_hard(
        _orders_history(spark, folder), _returned(spark, folder), {"o_orderkey": "l_orderkey"}
    )


def delete_hard_by_predicate(spark, folder):
    return delete_hard(
        _orders_history(spark, folder),
        _returned(spark, folder),
        {"o_orderkey": "l_orderkey"},
        _soon(),
    )


def delete_soft_by_key(spark, folder):
    """The key is NULL for one customer's orders; they are never deleted."""
    busy = (
        table(spark, folder, "orders")
        .groupBy(text("o_custkey").alias("o_custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 10)
    )
    return delete_soft(_orders_history(spark, folder), busy, {"cust_key": "o_custkey"})


def delete_soft_by_predicate(spark, folder):
    return delete_soft(
        _orders_history(spark, folder),
        _returned(spark, folder),
        {"o_orderkey": "l_orderkey"},
        _soon(),
    )


def _closed_weeks(spark, folder) -> DataFrame:
    """Spans of days from the suppliers: some a day long, some years, many overlapping."""
    suppliers = table(spark, folder, "supplier")
    start = F.date_add(F.lit("1992-01-01").cast("date"), ((F.col("s_suppkey") * 37) % 2400).cast("int"))
    long = F.when(F.col("s_suppkey") % 40 == 0, 300).otherwise(F.col("s_suppkey") % 3)
    return suppliers.filter("s_suppkey % 5 = 0").select(
        start.alias("from_day"), F.date_add(start, long.cast("int")).alias("to_day"), F.col("s_nationkey").alias("nation")
    )


def _dated_orders(spark, folder) -> DataFrame:
    return _orders_history(spark, folder).withColumn("day", F.col("start_ts").cast("date"))


def delete_hard_in_ranges(spark, folder):
    """Orders of a day that some span covers, without any key in common."""
    spans = Within("day", "from_day", "to_day")
    kept = delete_hard(_dated_orders(spark, folder), _closed_weeks(spark, folder), {}, within=spans)
    return portable(kept)


def delete_soft_in_ranges(spark, folder):
    """The same as a soft delete, where the span's nation must also differ from the order's."""
    other = F.col("s.nation") != F.col("t.o_orderkey") % 25
    spans = Within("day", "from_day", "to_day")
    closed = delete_soft(_dated_orders(spark, folder), _closed_weeks(spark, folder), {}, other, within=spans)
    return portable(closed)


def delete_hard_many_keys(spark, folder):
    """More delete keys than a broadcast should take: most items are kept without a shuffle."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    gone = table(spark, folder, "orders").filter(F.col("o_orderkey") % 10 == 3).select("o_orderkey")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        return delete_hard(items, gone, {"l_orderkey": "o_orderkey"})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


QUERIES = {
    "cdc_delete_capture": cdc_delete_capture,
    "delete_impact_count": delete_impact_count,
    "delete_hard_logged": delete_hard_by_log,
    "delete_soft_logged": delete_soft_by_log,
    "delete_hard_by_key": delete_hard_by_key,
    "delete_hard_by_predicate": delete_hard_by_predicate,
    "delete_soft_by_key": delete_soft_by_key,
    "delete_soft_by_predicate": delete_soft_by_predicate,
    "delete_hard_in_ranges": delete_hard_in_ranges,
    "delete_soft_in_ranges": delete_soft_in_ranges,
    "delete_hard_many_keys": delete_hard_many_keys,
}

# ------------------------------------------------------------------------- SQL

_LOG = f"""
g AS (
  SELECT CASE WHEN value > 250 THEN 'db.silver.other_t' ELSE '{MODEL}' END AS model_id,
         CAST(user_id AS VARCHAR) AS pk, min(ts) AS src_load_ts
  FROM events WHERE event_type = 'purchase' AND value > 150 GROUP BY 1, 2),
d AS (
  SELECT '{MODEL}' AS model_id, CAST(user_id AS VARCHAR) AS pk, ts AS src_load_ts
  FROM events WHERE event_type = 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
log AS (
  SELECT coalesce(g.model_id, d.model_id) AS model_id,
         CASE WHEN d.pk IS NULL THEN 'old_group' ELSE 'silver' END AS model_grp,
         CASE WHEN d.pk IS NULL THEN 'old_run' ELSE 'nightly' END AS pipeline_name,
         coalesce(g.pk, d.pk) AS pk,
         coalesce(g.src_load_ts, d.src_load_ts) AS src_load_ts,
         CASE WHEN g.pk IS NULL THEN '{BATCH[1]}' ELSE '{BATCH[0]}' END AS batch_id,
         CASE WHEN g.pk IS NULL THEN TIMESTAMP '{NOW[1]}' ELSE TIMESTAMP '{NOW[0]}' END
           AS etl_load_ts,
         CASE WHEN d.pk IS NULL THEN TIMESTAMP '{NOW[0]}' ELSE TIMESTAMP '{NOW[1]}' END
           AS etl_updt_ts
  FROM g FULL JOIN d ON g.model_id = d.model_id AND g.pk = d.pk)"""

_CUSTOMERS = f"""
c AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal > 1000 THEN 'Y' WHEN c_acctbal > 0 THEN 'N' END AS active_flg,
         'Y' AS reporting_flg,
         CASE WHEN c_acctbal > 0 AND c_acctbal <= 1000 THEN TIMESTAMP '{NOW[0]}' END AS end_ts,
         TIMESTAMP '{NOW[1]}' AS etl_updt_ts
  FROM customer)"""

_GONE = f"CAST(c_custkey AS VARCHAR) IN (SELECT pk FROM log WHERE upper(model_id) = upper('{MODEL}'))"

_ORDERS = """
t AS (
  SELECT o_orderkey, nullif(CAST(o_custkey AS VARCHAR), '7') AS cust_key, o_orderdate AS start_ts,
         CASE WHEN o_orderstatus = 'O' THEN 'N' ELSE 'Y' END AS active_flg,
         'Y' AS reporting_flg, CAST(NULL AS TIMESTAMP) AS end_ts,
         o_orderdate + INTERVAL 3 DAY AS etl_updt_ts
  FROM orders),
s AS (SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R')"""

_MATCH = (
    "EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.o_orderkey"
    " AND s.l_shipdate <= t.start_ts + INTERVAL 40 DAY)"
)


_SPANS = """
spans AS (
  SELECT DATE '1992-01-01' + CAST((s_suppkey * 37) % 2400 AS INTEGER) AS from_day,
    DATE '1992-01-01' + CAST((s_suppkey * 37) % 2400 + CASE WHEN s_suppkey % 40 = 0 THEN 300 ELSE s_suppkey % 3 END AS INTEGER) AS to_day,
    s_nationkey AS nation
  FROM supplier WHERE s_suppkey % 5 = 0),
d AS (SELECT *, CAST(start_ts AS DATE) AS day FROM t)"""
_IN_SPAN = "EXISTS (SELECT 1 FROM spans WHERE day BETWEEN from_day AND to_day)"
_IN_OTHERS = "EXISTS (SELECT 1 FROM spans WHERE day BETWEEN from_day AND to_day AND nation <> o_orderkey % 25)"


def _soft(rows: str, columns: str, gone: str) -> str:
    return f"""
SELECT {columns}, reporting_flg, etl_updt_ts,
       CASE WHEN active_flg = 'Y' AND {gone} THEN 'N' ELSE active_flg END AS active_flg,
       CASE WHEN active_flg = 'Y' AND {gone} THEN etl_updt_ts ELSE end_ts END AS end_ts
FROM {rows}"""


SQL = {
    "cdc_delete_capture": f"WITH {_LOG} SELECT * FROM log",
    "delete_impact_count": f"""
WITH {_LOG}, {_CUSTOMERS} SELECT count(*) AS deleted_count FROM c WHERE {_GONE}""",
    "delete_hard_logged": f"WITH {_LOG}, {_CUSTOMERS} SELECT * FROM c WHERE NOT ({_GONE})",
    "delete_soft_logged": f"WITH {_LOG}, {_CUSTOMERS} {_soft('c', 'c_custkey, c_name', _GONE)}",
    "delete_hard_by_key": f"""
WITH {_ORDERS} SELECT * FROM t WHERE o_orderkey NOT IN (SELECT l_orderkey FROM s)""",
    "delete_hard_by_predicate": f"WITH {_ORDERS} SELECT * FROM t WHERE NOT {_MATCH}",
    "delete_soft_by_key": f"""
WITH {_ORDERS},
b AS (SELECT CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders GROUP BY 1 HAVING count(*) > 10)
{_soft('t', 'o_orderkey, cust_key, start_ts',
       'coalesce(cust_key IN (SELECT o_custkey FROM b), FALSE)')}""",
    "delete_soft_by_predicate": f"""
WITH {_ORDERS} {_soft('t', 'o_orderkey, cust_key, start_ts', _MATCH)}""",
    "delete_hard_in_ranges": f"""
WITH {_ORDERS}, {_SPANS} SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM d WHERE NOT {_IN_SPAN}""",
    "delete_soft_in_ranges": f"""
WITH {_ORDERS}, {_SPANS} {_soft('d', 'o_orderkey, cust_key, start_ts, CAST(day AS VARCHAR) AS day', _IN_OTHERS)}""",
    "delete_hard_many_keys": """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 3)""",
}
