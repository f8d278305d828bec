"""Hash keys, name rules and the search for a write statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import (
    batch_id_from,
    delete_table_name,
    hash_key,
    name_parts,
    strip_key_list,
    table_for_view,
)
from tidemark.operators.audit import last_statement
from workload.common import portable, table, text


def hash_key_single(spark, folder):
    """Hash of one column that may be NULL, empty, padded or in lower case."""
    orders = table(spark, folder, "orders")
    value = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")))
    )
    rows = orders.select("o_orderkey", value.alias("priority"))
    return rows.select("o_orderkey", hash_key(["priority"]).alias("hash_value"))


def hash_key_multi(spark, folder):
    """Hashes of two columns (NULL where both are empty) and of columns of mixed types."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.col("o_orderpriority"))
        .alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return rows.select(
        "o_orderkey",
        hash_key(["status", "priority"]).alias("pair_hash"),
        hash_key(["status", "priority", "amount", "day", "o_orderkey"]).alias("row_hash"),
    )


def names_and_keys(spark, folder):
    """Table names behind views, names of delete tables, name parts and key lists."""
    parts = table(spark, folder, "part")
    view = F.concat(
        F.lit('"Db".silver.'),
        F.replace("p_name", F.lit(" "), F.lit("_")),
        F.when(F.col("p_size") > 25, F.lit("_V")).otherwise(F.lit("_v")),
    )
    named = parts.select("p_partkey", view.alias("view_name"), "p_brand", "p_type")
    pieces = name_parts("view_name")
    keys = F.concat(F.lit("['"), F.col("p_brand"), F.lit("', '"), F.col("p_type"), F.lit("']"))
    return named.select(
        "p_partkey",
        table_for_view("view_name").alias("table_name"),
        delete_table_name(table_for_view("view_name")).alias("delete_table"),
        pieces["db"].alias("db_name"),
        pieces["schema"].alias("schema_name"),
        pieces["table"].alias("short_name"),
        strip_key_list(keys).alias("key_columns"),
    )


def batch_id_digits(spark, folder):
    events = table(spark, folder, "events")
    return portable(events.select("event_id", batch_id_from(F.col("ts")).alias("batch_id")))


def last_write_statement(spark, folder):
    """The newest write that names a table, in a statement history made of the events."""
    events = table(spark, folder, "events")
    verb = (
        F.when(F.col("event_type") == "view", F.lit("select"))
        .when(F.col("event_type") == "click", F.lit("MERGE"))
        .otherwise(F.lit("INSERT"))
    )
    where = F.when(F.col("value") > 100, F.lit("DBT_MONITOR.audit_t")).otherwise(
        F.lit("silver.payment_t")
    )
    history = events.select(
        text("event_id").alias("query_id"),
        F.concat(
            verb, F.lit(" into "), where, F.lit(" 'user "), text("user_id"), F.lit("'")
        ).alias("query_text"),
        verb.alias("query_type"),
        F.col("ts").alias("end_time"),
    )
    # Two weeks instead of 100 seconds: events are minutes apart.
    return last_statement(history, "silver.payment_t", "2024-01-31 00:00:00", 14 * 86400)


QUERIES = {
    "hash_key_single": hash_key_single,
    "hash_key_multi": hash_key_multi,
    "names_and_keys": names_and_keys,
    "batch_id_digits": batch_id_digits,
    "last_write_statement": last_write_statement,
}

_MARKED = "coalesce(nullif(upper(trim({})), ''), '^^')"

SQL = {
    "hash_key_single": f"""
SELECT o_orderkey, sha256({_MARKED.format('priority')}) AS hash_value
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN '  '
             ELSE ' ' || lower(o_orderpriority) || ' ' END AS priority FROM orders)""",
    "hash_key_multi": f"""
WITH r AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders),
h AS (
  SELECT o_orderkey, amount, day, {_MARKED.format('status')} || '||' || {_MARKED.format('priority')}
           AS pair FROM r)
SELECT o_orderkey,
       CASE WHEN pair <> '^^||^^' THEN sha256(pair) END AS pair_hash,
       sha256(pair || '||' || amount || '||' || day || '||' || CAST(o_orderkey AS VARCHAR))
         AS row_hash
FROM h""",
    "names_and_keys": """
WITH n AS (SELECT *, 'Db' AS db_name, replace(p_name, ' ', '_') AS base FROM part)
SELECT p_partkey, '"Db".silver.' || base || '_t' AS table_name,
       '"Db".silver.' || base || '_del_t' AS delete_table, db_name, 'silver' AS schema_name,
       base || CASE WHEN p_size > 25 THEN '_V' ELSE '_v' END AS short_name,
       p_brand || ', ' || p_type AS key_columns
FROM n""",
    "batch_id_digits": """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S%n') AS batch_id FROM events""",
    "last_write_statement": """
SELECT CAST(event_id AS VARCHAR) AS query_id,
       CASE event_type WHEN 'click' THEN 'MERGE' ELSE 'INSERT' END || ' into silver.payment_t ''''user '
         || CAST(user_id AS VARCHAR) || '''''' AS query_text
FROM events
WHERE event_type <> 'view' AND NOT coalesce(value > 100, FALSE)
  AND ts >= TIMESTAMP '2024-01-17 00:00:00'
ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1""",
}
