"""Payloads of mixed shape, drift inside payloads, and the library called from SQL text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.in_sql import register_functions
from tidemark.functions.times import moment
from tidemark.operators.payload_drift import payload_drift, payload_fields
from tidemark.operators.quality.config import PROJECT, upsert_readable
from tidemark.operators.quality.in_sql import register_rule
from workload.common import MARK, NOW, portable, table, text
from workload.quality import _stamped

# -------------------------------------------------- config payloads of any shape


def _config(spark, folder):
    """Customers as projects: payloads broken, of mixed elements, without a key, no array,
    NULL, or whole, by customer number."""
    customers = table(spark, folder, "customer")
    key, case = text("c_custkey").alias("project_id"), F.col("c_custkey") % 7
    flag = F.when(F.col("c_acctbal") > 0, F.lit("Y")).otherwise("N").alias("active_flg")
    known = _stamped(
        customers.filter(F.col("c_acctbal") > 3000).select(
            key, F.lit("old").alias("project_name"), F.lit("nobody").alias("owner"), flag
        )
    )
    project = F.to_json(
        F.struct(key, F.struct(F.col("c_name").alias("first")).alias("project_name"), F.col("c_nationkey").alias("owner"), flag)
    )
    payload = (
        F.when(case == 0, F.concat(F.lit("["), F.substring(project, 1, 20)))
        .when(case == 1, F.concat(F.lit("["), project, F.lit(', 7, "x"]')))
        .when(case == 2, F.concat(F.lit("["), F.to_json(F.struct(F.col("c_name").alias("owner"))), F.lit("]")))
        .when(case == 3, project)
        .when(case > 4, F.concat(F.lit("["), project, F.lit("]")))
    )
    return upsert_readable(known, customers.select(payload.alias("payload")), PROJECT, NOW[1])


def dq_config_readable(spark, folder):
    """The projects after the elements that could be read."""
    return _config(spark, folder)[0]


def dq_config_rejects(spark, folder):
    """What could not be read, and why; -1 stands for a payload as a whole."""
    rejects = _config(spark, folder)[1]
    return rejects.select("reason", F.coalesce("pos", F.lit(-1)).alias("pos"), "element")


# -------------------------------------------------------- drift inside payloads


def schema_drift_payload(spark, folder):
    """Orders of a priority as a model: the last load lost a field, has a new one, and brings
    others in another type, in all of its rows or in some."""
    orders = table(spark, folder, "orders")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    size = (F.col("o_orderkey") % 50).cast("string")
    quoted = lambda column: F.concat(F.lit('"'), column, F.lit('"'))
    priority = F.col("o_orderpriority")
    first = F.concat(
        F.lit('{"application_id":'), quoted(text("o_orderkey")), F.lit(',"customer_id":'), quoted(text("o_custkey")),
        F.lit(',"amount":'), amount, F.lit(',"details":{"size":'), size, F.lit('},"note":null}'),
    )
    last = F.concat(
        F.lit('{"application_id":'), quoted(text("o_orderkey")), F.lit(',"amount":'),
        F.when((priority == "3-MEDIUM") | (F.col("o_orderstatus") == "P"), quoted(amount)).otherwise(amount),
        F.lit(',"details":{"size":'), F.when(priority == "5-LOW", quoted(size)).otherwise(size), F.lit("}"),
        F.when(priority < "3", F.lit(',"channel":"web"')).otherwise(F.lit("")), F.lit(',"note":"late"}'),
    )
    late = F.col("o_orderdate") > moment(MARK[1])
    raw = orders.select(
        priority.alias("model_id"), late.alias("late"), F.parse_json(F.when(late, last).otherwise(first)).alias("raw_json")
    )
    return payload_drift(payload_fields(raw.filter("late")), payload_fields(raw.filter("NOT late")))


# ------------------------------------------------------------- called from SQL


def functions_in_sql(spark, folder):
    """Hash keys, batch ids, times and names by functions in SQL text."""
    register_functions(spark, "tidemark_")
    return spark.sql(
        """
        SELECT o_orderkey,
          tidemark_hash_key(array(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'))) AS pair_hash,
          tidemark_hash_key(array(string(o_orderkey), concat(' ', lower(o_orderpriority), ' '))) AS row_hash,
          CAST(tidemark_batch_id_from(CAST(o_orderdate AS TIMESTAMP_NTZ)) AS STRING) AS batch_id,
          tidemark_iso_text(CAST(o_orderdate AS TIMESTAMP_NTZ)) AS order_time,
          tidemark_name_parts(tidemark_delete_table_name(tidemark_table_for_view(
            concat('"Db".silver.', o_orderpriority, '_v')))).table AS delete_table,
          tidemark_strip_key_list(concat("['", o_orderstatus, "', '", o_orderpriority, "']")) AS key_columns
        FROM {orders}""",
        orders=table(spark, folder, "orders"),
    )


def dq_rules_in_sql(spark, folder):
    """Rows that fail a rule as tables in SQL, filtered and counted beside all rows."""
    run = uuid.uuid4().hex
    rows, missing, repeated = (f"{name}_{run}" for name in ("items", "missing", "repeated"))
    register_functions(spark, "tidemark_")
    items = table(spark, folder, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("R")))
    items.createOrReplaceTempView(rows)
    try:
        register_rule(spark, missing, "dq_rule_not_null", {"table_name": rows, "column_name": "flag"})
        register_rule(spark, repeated, "dq_rule_unique", {"table_name": rows, "key_column": "l_partkey, l_suppkey"})
        return portable(
            spark.sql(
                f"""
                WITH total AS (SELECT l_linestatus, count(*) AS n FROM {rows} WHERE l_quantity > 10 GROUP BY ALL),
                failed AS (
                  SELECT 'missing' AS rule, l_linestatus, count(*) AS n FROM {missing}() WHERE l_quantity > 10 GROUP BY ALL
                  UNION ALL
                  SELECT 'repeated', l_linestatus, count(*) FROM {repeated}() WHERE l_quantity > 10 GROUP BY ALL)
                SELECT rule, l_linestatus, failed.n AS failed, tidemark_failure_ratio(failed.n, total.n) AS failure_ratio,
                  tidemark_result_status(failed.n) AS result_status
                FROM failed JOIN total USING (l_linestatus)"""
            )
        )
    finally:
        # The plan above has taken them in.
        for function in (missing, repeated):
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {function}")
        spark.catalog.dropTempView(rows)


QUERIES = {
    "dq_config_readable": dq_config_readable,
    "dq_config_rejects": dq_config_rejects,
    "schema_drift_payload": schema_drift_payload,
    "functions_in_sql": functions_in_sql,
    "dq_rules_in_sql": dq_rules_in_sql,
}

# ------------------------------------------------------------------------- SQL

_MARKED = "coalesce(nullif(upper(trim({})), ''), '^^')"
_FLAG = "CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END"
_PROJECT = f"""'{{"project_id":"' || c_custkey || '","project_name":{{"first":"' || c_name || '"}},"owner":' ||
  c_nationkey || ',"active_flg":"' || {_FLAG} || '"}}'"""

SQL = {
    "dq_config_readable": f"""
WITH n AS (
  SELECT CAST(c_custkey AS VARCHAR) AS project_id, '{{"first":"' || c_name || '"}}' AS project_name,
    CAST(c_nationkey AS VARCHAR) AS owner, {_FLAG} AS active_flg FROM customer WHERE c_custkey % 7 IN (1, 5, 6)),
o AS (
  SELECT CAST(c_custkey AS VARCHAR) AS project_id, 'old' AS project_name, 'nobody' AS owner, {_FLAG} AS active_flg
  FROM customer WHERE c_acctbal > 3000)
SELECT project_id, coalesce(n.project_name, o.project_name) AS project_name, coalesce(n.owner, o.owner) AS owner,
  coalesce(n.active_flg, o.active_flg) AS active_flg,
  CASE WHEN o.owner IS NULL THEN TIMESTAMP '{NOW[1]}' ELSE TIMESTAMP '{NOW[0]}' END AS created_ts,
  CASE WHEN n.owner IS NULL THEN TIMESTAMP '{NOW[0]}' ELSE TIMESTAMP '{NOW[1]}' END AS modified_ts
FROM n FULL JOIN o USING (project_id)""",
    "dq_config_rejects": f"""
WITH p AS (SELECT c_custkey % 7 AS kind, {_PROJECT} AS project, c_name FROM customer)
SELECT 'not json' AS reason, -1 AS pos, '[' || left(project, 20) AS element FROM p WHERE kind = 0
UNION ALL SELECT 'not an object', 1, '7' FROM p WHERE kind = 1
UNION ALL SELECT 'not an object', 2, '"x"' FROM p WHERE kind = 1
UNION ALL SELECT 'no key', 0, '{{"owner":"' || c_name || '"}}' FROM p WHERE kind = 2
UNION ALL SELECT 'not an array', -1, project FROM p WHERE kind = 3""",
    "schema_drift_payload": f"""
WITH o AS (SELECT *, o_orderpriority AS model_id, o_orderdate > TIMESTAMP '{MARK[1]}' AS late FROM orders),
source AS (
  SELECT model_id, unnest(['application_id', 'amount', 'details', 'note', 'channel']) AS column_name,
    unnest(['string',
      CASE WHEN model_id = '3-MEDIUM' OR bool_and(o_orderstatus = 'P') THEN 'string'
           WHEN bool_or(o_orderstatus = 'P') THEN 'variant' ELSE 'number' END,
      CASE WHEN model_id = '5-LOW' THEN 'object<size: string>' ELSE 'object<size: number>' END,
      'string', CASE WHEN model_id < '3' THEN 'string' END]) AS source_column_type
  FROM o WHERE late GROUP BY model_id),
target AS (
  SELECT model_id, unnest(['application_id', 'amount', 'details', 'note', 'customer_id']) AS column_name,
    unnest(['string', 'number', 'object<size: number>', 'void', 'string']) AS target_column_type
  FROM o WHERE NOT late GROUP BY model_id)
SELECT model_id, column_name, source_column_type, target_column_type,
  CASE WHEN target_column_type IS NULL THEN 'MISSING_IN_TARGET' WHEN source_column_type IS NULL THEN 'MISSING_IN_SOURCE'
       ELSE 'TYPE_MISMATCH' END AS diff_type
FROM (SELECT * FROM source WHERE source_column_type IS NOT NULL) FULL JOIN target USING (model_id, column_name)
WHERE source_column_type IS NULL OR target_column_type IS NULL
   OR (source_column_type <> target_column_type AND target_column_type <> 'void')""",
    "functions_in_sql": f"""
WITH h AS (
  SELECT *, {_MARKED.format("nullif(o_orderstatus, 'P')")} || '||' || {_MARKED.format("nullif(o_orderpriority, '5-LOW')")} AS pair
  FROM orders)
SELECT o_orderkey, CASE WHEN pair <> '^^||^^' THEN sha256(pair) END AS pair_hash,
  sha256(o_orderkey || '||' || o_orderpriority) AS row_hash,
  strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d%H%M%S%n') AS batch_id,
  strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS order_time,
  o_orderpriority || '_del_t' AS delete_table, o_orderstatus || ', ' || o_orderpriority AS key_columns
FROM h""",
    "dq_rules_in_sql": """
WITH total AS (SELECT l_linestatus, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY ALL),
numbered AS (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS times FROM lineitem),
failed AS (
  SELECT 'missing' AS rule, l_linestatus, count(*) AS n FROM lineitem WHERE l_quantity > 10 AND l_returnflag = 'R' GROUP BY ALL
  UNION ALL SELECT 'repeated', l_linestatus, count(*) FROM numbered WHERE l_quantity > 10 AND times > 1 GROUP BY ALL)
SELECT rule, l_linestatus, failed.n AS failed, CAST(failed.n AS DOUBLE) / CAST(total.n AS DOUBLE) * 100.0 AS failure_ratio,
  'Fail' AS result_status
FROM failed JOIN total USING (l_linestatus)""",
}
