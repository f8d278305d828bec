"""Batch ledger, load audit, load statistics and schema drift.

Every user of the event stream stands for a pipeline or a model, every day for a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import batch_id_from, batch_number, moment
from tidemark.operators import audit as audits
from tidemark.operators import batches, drift
from workload.common import BATCH, NOW, portable, table, text

_COUNTED = ("rows_inserted", "rows_updated")


def _day():
    return F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day")


def _ledger(spark, folder) -> DataFrame:
    """One batch per user and day; its state follows from the day's largest value."""
    events = table(spark, folder, "events").select("user_id", "ts", "value")
    top = F.max("value")
    days = events.groupBy("user_id", _day()).agg(
        F.when(top > 200, F.lit("running"))
        .when(top > 150, F.lit("failed"))
        .when(top > 5, F.lit("completed"))
        .alias("batch_status"),
        F.min("ts").alias("start_ts"),
        F.when(top <= 150, F.max("ts")).alias("end_ts"),
    )
    return days.select(
        F.concat(F.lit("user "), text("user_id")).alias("pipeline_name"),
        batch_id_from(F.col("day")).alias("batch_id"),
        "batch_status",
        "start_ts",
        "end_ts",
    )


def _pipelines(spark, folder) -> DataFrame:
    """All customers: some have batches as users, most have none yet."""
    customers = table(spark, folder, "customer")
    return customers.select(F.concat(F.lit("user "), text("c_custkey")).alias("pipeline_name"))


def batch_open(spark, folder):
    return portable(
        batches.open_batches(_ledger(spark, folder), _pipelines(spark, folder), NOW[0])
    )


def batch_merge(spark, folder):
    """Batches of purchase days: known ones lose their end time, others are added."""
    events = table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    days = events.groupBy("user_id", _day()).agg(
        F.max("ts").alias("start_ts"), F.min("value").alias("low")
    )
    # Cheap purchases open a second batch of the day, half a day later.
    late = F.when(F.col("low") < 20, F.col("day") + F.expr("INTERVAL 12 HOURS"))
    rows = days.select(
        F.concat(F.lit("user "), text("user_id")).alias("pipeline_name"),
        batch_id_from(F.coalesce(late, "day")).alias("batch_id"),
        F.lit("running").alias("batch_status"),
        "start_ts",
        moment(None).alias("end_ts"),
    )
    return portable(batches.merge_batches(_ledger(spark, folder), rows))


def batch_close(spark, folder):
    """Close the batches of rich customers' pipelines."""
    rich = table(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    named = rich.select(F.concat(F.lit("user "), text("c_custkey")).alias("pipeline_name"))
    return portable(batches.close_batches(_ledger(spark, folder), named, NOW[0]))


def batch_current(spark, folder):
    return batches.current_batch(_ledger(spark, folder), _pipelines(spark, folder))


def _audit(spark, folder) -> DataFrame:
    """One row per event type (pipeline), user (model) and day (batch)."""
    events = table(spark, folder, "events").select("event_type", "user_id", "ts", "value")
    top = F.max("value")
    days = events.groupBy(
        "event_type", "user_id", _day()
    ).agg(
        F.when(top > 10, F.max("ts")).alias("inc_load_ts"),
        F.when(top > 150, F.lit("running"))
        .when(top > 15, F.lit("completed"))
        .alias("model_load_status"),
        F.when(top <= 150, F.count(F.lit(1))).alias("rows_inserted"),
        F.when(top <= 100, F.count_if(F.col("value") > 30)).alias("rows_updated"),
        F.min("ts").alias("start_ts"),
        F.when(top <= 150, F.max("ts")).alias("end_ts"),
    )
    return days.select(
        text("user_id").alias("model_id"),
        F.lit("silver").alias("model_grp"),
        "inc_load_ts",
        F.col("event_type").alias("pipeline_name"),
        batch_id_from(F.col("day")).alias("batch_id"),
        "model_load_status",
        "rows_inserted",
        "rows_updated",
        "start_ts",
        "end_ts",
        F.lit(None).cast("string").alias("query_id"),
        F.lit(None).cast("string").alias("query_text"),
    )


def _models(spark, folder) -> DataFrame:
    """Customers as models of two pipelines: a new batch, or a rerun of January 15th."""
    customers = table(spark, folder, "customer")
    rerun = F.col("c_acctbal") > 5000
    return customers.select(
        F.explode(F.array(F.lit("view"), F.lit("click"))).alias("pipeline_name"),
        F.lit("silver").alias("model_grp"),
        text("c_custkey").alias("model_id"),
        batch_number(
            F.when(rerun, F.lit("20240115000000000000000")).otherwise(F.lit(BATCH[0]))
        ).alias("batch_id"),
    )


def audit_register(spark, folder):
    return portable(
        audits.register_models(_audit(spark, folder), _models(spark, folder)), *_COUNTED
    )


def audit_start(spark, folder):
    return portable(
        audits.start_models(_audit(spark, folder), _models(spark, folder), NOW[0]), *_COUNTED
    )


def audit_reset(spark, folder):
    return portable(
        audits.reset_models(_audit(spark, folder), _models(spark, folder), NOW[0]), *_COUNTED
    )


def audit_lookup(spark, folder):
    return portable(audits.audit_lookup(_audit(spark, folder), _models(spark, folder)))


def _loaded(spark, folder) -> DataFrame:
    """Line items as loaded rows: suppliers are models, years batches."""
    items = table(spark, folder, "lineitem")
    late = F.when(F.col("l_linenumber") > 4, F.expr("INTERVAL 1 DAY")).otherwise(
        F.expr("INTERVAL 0 DAY")
    )
    return items.select(
        text("l_suppkey").alias("model_id"),
        batch_number(F.date_format("l_shipdate", "yyyy")).alias("batch_id"),
        F.col("l_shipdate").alias("src_load_ts"),
        F.col("l_shipdate").alias("etl_load_ts"),
        (F.col("l_shipdate") + late).alias("etl_updt_ts"),
    )


def load_stats(spark, folder):
    return portable(audits.load_stats(_loaded(spark, folder), by=["batch_id"]))


def load_stats_one_batch(spark, folder):
    """Counts of a batch that has no rows are NULL."""
    loaded = _loaded(spark, folder)
    known = audits.load_stats(loaded, batch_id="1998").withColumn("batch", F.lit("known"))
    none = audits.load_stats(loaded, batch_id="1901").withColumn("batch", F.lit("none"))
    return portable(known.unionByName(none), *_COUNTED)


def _load_audit(spark, folder) -> DataFrame:
    """Started models: one per supplier and year of shipping or of ordering."""
    loaded = _loaded(spark, folder).select("model_id", "batch_id")
    early = table(spark, folder, "supplier").select(
        text("s_suppkey").alias("model_id"), batch_number("1990").alias("batch_id")
    )
    return (
        loaded.distinct()
        .unionByName(early)
        .select(
            "model_id",
            F.lit("silver").alias("model_grp"),
            moment("1994-01-01").alias("inc_load_ts"),
            F.lit("items").alias("pipeline_name"),
            "batch_id",
            F.lit("running").alias("model_load_status"),
            F.lit(None).cast("long").alias("rows_inserted"),
            F.lit(None).cast("long").alias("rows_updated"),
            moment(NOW[0]).alias("start_ts"),
            moment(None).alias("end_ts"),
            F.lit(None).cast("string").alias("query_id"),
            F.lit(None).cast("string").alias("query_text"),
        )
    )


def _named(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"pipeline_name": F.lit("items"), "model_grp": F.lit("silver")})


def audit_complete(spark, folder):
    stats = audits.load_stats(_loaded(spark, folder), by=["model_id", "batch_id"]).withColumns(
        {"query_id": F.lit("q1"), "query_text": F.lit("merge into items")}
    )
    # A load without newer rows keeps the old mark.
    stale = F.when(F.col("rows_updated") > 20, F.col("new_watermark"))
    stats = stats.withColumn("new_watermark", stale)
    return portable(
        audits.complete_models(_load_audit(spark, folder), _named(stats), NOW[1]), *_COUNTED
    )


def audit_complete_full_reload(spark, folder):
    stats = audits.full_reload_stats(_loaded(spark, folder), by=["model_id", "batch_id"])
    return portable(
        audits.complete_models(
            _load_audit(spark, folder), _named(stats), NOW[1], full_reload=True
        ),
        *_COUNTED,
    )


def _column_list(spark, folder, source: bool) -> DataFrame:
    """Column lists of many models: suppliers are models, their parts columns."""
    items = table(spark, folder, "lineitem")
    kind = F.when(F.max("l_quantity") > 45, F.lit("DECIMAL(18,2)")).when(
        F.max("l_quantity") > 25, F.lit("Bigint")
    )
    columns = (
        items.filter(F.col("l_linestatus") == ("O" if source else "F"))
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.coalesce(kind, F.lit("string")).alias("data_type"))
    )
    head = F.lit("Col_" if source else "COL_")
    audit_column = F.lit("BATCH_ID" if source else "etl_load_ts")
    # Every supplier also has an audit column, which is not compared.
    suppliers = table(spark, folder, "supplier").select(
        text("s_suppkey").alias("model_id"),
        audit_column.alias("column_name"),
        F.lit("date").alias("data_type"),
    )
    return columns.select(
        text("l_suppkey").alias("model_id"),
        F.concat(head, text("l_partkey")).alias("column_name"),
        "data_type",
    ).unionByName(suppliers)


def schema_drift(spark, folder):
    return drift.schema_drift(
        _column_list(spark, folder, source=True), _column_list(spark, folder, source=False)
    )


def schema_drift_log(spark, folder):
    """Drift recorded for a batch that was recorded before, with other findings."""
    found = drift.schema_drift(
        _column_list(spark, folder, source=True), _column_list(spark, folder, source=False)
    )
    suppliers = table(spark, folder, "supplier").select(text("s_suppkey").alias("model_id"))
    earlier = table(spark, folder, "part").select(
        text("p_size").alias("model_id"),
        F.lit("silver").alias("model_grp"),
        F.lit("items").alias("pipeline_name"),
        F.lit("raw.items").alias("source_table"),
        F.lit("silver.items").alias("target_table"),
        F.concat(F.lit("old_"), text("p_partkey")).alias("column_name"),
        F.lit("string").alias("source_column_type"),
        F.lit(None).cast("string").alias("target_column_type"),
        F.lit("MISSING_IN_TARGET").alias("diff_type"),
        batch_number(
            F.when(F.col("p_retailprice") > 950, F.lit(BATCH[0])).otherwise(F.lit(BATCH[1]))
        ).alias("batch_id"),
        moment(NOW[0]).alias("etl_load_ts"),
        moment(NOW[0]).alias("etl_updt_ts"),
    )
    return portable(
        drift.record_drift(
            earlier,
            found,
            model_grp=F.lit("silver"),
            pipeline_name=F.lit("items"),
            source_table=F.lit("raw.items"),
            target_table=F.lit("silver.items"),
            batch_id=BATCH[1],
            now=NOW[1],
            checked=suppliers,
        )
    )


QUERIES = {
    "batch_open": batch_open,
    "batch_merge": batch_merge,
    "batch_close": batch_close,
    "batch_current": batch_current,
    "audit_register": audit_register,
    "audit_start": audit_start,
    "audit_reset": audit_reset,
    "audit_lookup": audit_lookup,
    "load_stats": load_stats,
    "load_stats_one_batch": load_stats_one_batch,
    "audit_complete": audit_complete,
    "audit_complete_full_reload": audit_complete_full_reload,
    "schema_drift": schema_drift,
    "schema_drift_log": schema_drift_log,
}

# ------------------------------------------------------------------------- SQL

_DIGITS = "strftime({}, '%Y%m%d%H%M%S%n')"

_LEDGER = f"""
ledger AS (
  SELECT 'user ' || CAST(user_id AS VARCHAR) AS pipeline_name,
         {_DIGITS.format("CAST(date_trunc('day', ts) AS TIMESTAMP)")} AS batch_id,
         CASE WHEN max(value) > 200 THEN 'running' WHEN max(value) > 150 THEN 'failed'
              WHEN max(value) > 5 THEN 'completed' END AS batch_status,
         min(ts) AS start_ts, CASE WHEN max(value) <= 150 THEN max(ts) END AS end_ts
  FROM events GROUP BY user_id, date_trunc('day', ts)),
wanted AS (
  SELECT 'user ' || CAST(c_custkey AS VARCHAR) AS pipeline_name, c_acctbal FROM customer)"""

_AUDIT = f"""
audit AS (
  SELECT CAST(user_id AS VARCHAR) AS model_id, 'silver' AS model_grp,
         CASE WHEN max(value) > 10 THEN max(ts) END AS inc_load_ts,
         event_type AS pipeline_name,
         {_DIGITS.format("CAST(date_trunc('day', ts) AS TIMESTAMP)")} AS batch_id,
         CASE WHEN max(value) > 150 THEN 'running' WHEN max(value) > 15 THEN 'completed' END
           AS model_load_status,
         CAST(CASE WHEN max(value) <= 150 THEN count(*) END AS DOUBLE) AS rows_inserted,
         CAST(CASE WHEN max(value) <= 100 THEN count(*) FILTER (value > 30) END AS DOUBLE) AS rows_updated,
         min(ts) AS start_ts, CASE WHEN max(value) <= 150 THEN max(ts) END AS end_ts,
         CAST(NULL AS VARCHAR) AS query_id, CAST(NULL AS VARCHAR) AS query_text
  FROM events GROUP BY event_type, user_id, date_trunc('day', ts)),
models AS (
  SELECT p.pipeline_name, 'silver' AS model_grp, CAST(c_custkey AS VARCHAR) AS model_id,
         CASE WHEN c_acctbal > 5000 THEN '20240115000000000000000' ELSE '{BATCH[0]}' END AS batch_id
  FROM customer, (VALUES ('view'), ('click')) p(pipeline_name)),
last_mark AS (
  SELECT pipeline_name, model_grp, model_id, inc_load_ts FROM audit
  QUALIFY row_number() OVER (PARTITION BY pipeline_name, model_grp, model_id
                             ORDER BY batch_id DESC) = 1)"""

_ON = """a.pipeline_name = m.pipeline_name AND a.model_grp = m.model_grp
    AND a.model_id = m.model_id AND a.batch_id = m.batch_id"""


def _entered(status: str, start: str, hit_status: str, hit_start: str, hit_end: str) -> str:
    return f"""
WITH {_AUDIT},
old_rows AS (
  SELECT a.model_id, a.model_grp, a.inc_load_ts, a.pipeline_name, a.batch_id,
         CASE WHEN m.model_id IS NULL THEN a.model_load_status ELSE {hit_status} END
           AS model_load_status,
         a.rows_inserted, a.rows_updated,
         CASE WHEN m.model_id IS NULL THEN a.start_ts ELSE {hit_start} END AS start_ts,
         CASE WHEN m.model_id IS NULL THEN a.end_ts ELSE {hit_end} END AS end_ts,
         a.query_id, a.query_text
  FROM audit a LEFT JOIN models m ON {_ON}),
new_rows AS (
  SELECT m.model_id, m.model_grp, l.inc_load_ts, m.pipeline_name, m.batch_id,
         '{status}' AS model_load_status, CAST(NULL AS DOUBLE) AS rows_inserted,
         CAST(NULL AS DOUBLE) AS rows_updated, {start} AS start_ts,
         CAST(NULL AS TIMESTAMP) AS end_ts, CAST(NULL AS VARCHAR) AS query_id,
         CAST(NULL AS VARCHAR) AS query_text
  FROM models m LEFT JOIN last_mark l USING (pipeline_name, model_grp, model_id)
  WHERE NOT EXISTS (SELECT 1 FROM audit a WHERE {_ON}))
SELECT * FROM old_rows UNION ALL SELECT * FROM new_rows"""


_STARTED = "CASE WHEN a.end_ts IS NULL THEN 'running' ELSE a.model_load_status END"

_LOADED = """
loaded AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS model_id, strftime(l_shipdate, '%Y') AS batch_id,
         l_shipdate AS src_load_ts, l_shipdate AS etl_load_ts,
         l_shipdate + CASE WHEN l_linenumber > 4 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
           AS etl_updt_ts
  FROM lineitem)"""

_COUNTS = """max(src_load_ts) AS new_watermark,
  CAST(sum(CASE WHEN etl_load_ts = etl_updt_ts THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
  CAST(sum(CASE WHEN etl_load_ts < etl_updt_ts THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated"""

_MAYBE = _COUNTS.replace("BIGINT", "DOUBLE")

_STARTED_AUDIT = f"""
audit AS (
  SELECT model_id, batch_id FROM loaded GROUP BY 1, 2
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), '1990' FROM supplier),
stats AS (SELECT model_id, batch_id, {_COUNTS}, count(*) AS all_rows FROM loaded GROUP BY 1, 2)"""


def _completed(mark: str, inserted: str, updated: str, query: str, statement: str) -> str:
    hit = "CASE WHEN s.model_id IS NULL THEN {} ELSE {} END AS {}"
    columns = [
        hit.format("TIMESTAMP '1994-01-01 00:00:00'", mark, "inc_load_ts"),
        hit.format("'running'", "'completed'", "model_load_status"),
        f"CAST(CASE WHEN s.model_id IS NOT NULL THEN {inserted} END AS DOUBLE) AS rows_inserted",
        f"CAST(CASE WHEN s.model_id IS NOT NULL THEN {updated} END AS DOUBLE) AS rows_updated",
        hit.format("NULL", f"TIMESTAMP '{NOW[1]}'", "end_ts"),
        f"CAST(CASE WHEN s.model_id IS NOT NULL THEN {query} END AS VARCHAR) AS query_id",
        f"CAST(CASE WHEN s.model_id IS NOT NULL THEN {statement} END AS VARCHAR) AS query_text",
    ]
    return f"""
WITH {_LOADED}, {_STARTED_AUDIT}
SELECT a.model_id, 'silver' AS model_grp, 'items' AS pipeline_name, a.batch_id,
       TIMESTAMP '{NOW[0]}' AS start_ts, {', '.join(columns)}
FROM audit a LEFT JOIN stats s ON a.model_id = s.model_id AND a.batch_id = s.batch_id"""


def _column_sql(status: str) -> str:
    return f"""
  SELECT CAST(l_suppkey AS VARCHAR) AS model_id, 'col_' || CAST(l_partkey AS VARCHAR) AS column_name,
         CASE WHEN max(l_quantity) > 45 THEN 'decimal(18,2)' WHEN max(l_quantity) > 25 THEN 'bigint'
              ELSE 'string' END AS data_type
  FROM lineitem WHERE l_linestatus = '{status}' GROUP BY l_suppkey, l_partkey"""


_DRIFT = f"""
s AS ({_column_sql('O')}), t AS ({_column_sql('F')}),
found AS (
  SELECT coalesce(s.model_id, t.model_id) AS model_id,
         coalesce(s.column_name, t.column_name) AS column_name,
         s.data_type AS source_column_type, t.data_type AS target_column_type,
         CASE WHEN t.model_id IS NULL THEN 'MISSING_IN_TARGET'
              WHEN s.model_id IS NULL THEN 'MISSING_IN_SOURCE' ELSE 'TYPE_MISMATCH' END AS diff_type
  FROM s FULL JOIN t ON s.model_id = t.model_id AND s.column_name = t.column_name
  WHERE s.data_type IS DISTINCT FROM t.data_type)"""

SQL = {
    "batch_open": f"""
WITH {_LEDGER}
SELECT * FROM ledger
UNION ALL
SELECT pipeline_name, {_DIGITS.format(f"TIMESTAMP '{NOW[0]}'")}, 'running', TIMESTAMP '{NOW[0]}', NULL
FROM wanted
WHERE pipeline_name NOT IN (SELECT pipeline_name FROM ledger WHERE batch_status <> 'completed')""",
    "batch_merge": f"""
WITH {_LEDGER},
src AS (
  SELECT 'user ' || CAST(user_id AS VARCHAR) AS pipeline_name,
         {_DIGITS.format("CAST(date_trunc('day', ts) AS TIMESTAMP) + CASE WHEN min(value) < 20 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END")}
           AS batch_id, max(ts) AS start_ts
  FROM events WHERE event_type = 'purchase' GROUP BY user_id, date_trunc('day', ts))
SELECT l.pipeline_name, l.batch_id, l.batch_status, l.start_ts,
       CASE WHEN s.batch_id IS NULL THEN l.end_ts END AS end_ts
FROM ledger l LEFT JOIN src s ON l.pipeline_name = s.pipeline_name AND l.batch_id = s.batch_id
UNION ALL
SELECT pipeline_name, batch_id, 'running', start_ts, NULL FROM src s
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.pipeline_name = s.pipeline_name
                    AND l.batch_id = s.batch_id)""",
    "batch_close": f"""
WITH {_LEDGER},
m AS (SELECT *, coalesce(batch_status = 'running', FALSE) AND pipeline_name IN
               (SELECT pipeline_name FROM wanted WHERE c_acctbal > 0) AS hit FROM ledger)
SELECT pipeline_name, batch_id, CASE WHEN hit THEN 'completed' ELSE batch_status END AS batch_status,
       start_ts, CASE WHEN hit THEN TIMESTAMP '{NOW[0]}' ELSE end_ts END AS end_ts FROM m""",
    "batch_current": f"""
WITH {_LEDGER}
SELECT w.pipeline_name, coalesce(max(l.batch_id), '00000000') AS batch_id
FROM wanted w LEFT JOIN ledger l ON w.pipeline_name = l.pipeline_name AND l.batch_status = 'running'
GROUP BY 1""",
    "audit_register": _entered(
        "yet to start",
        "CAST(NULL AS TIMESTAMP)",
        "CASE WHEN a.end_ts IS NULL THEN 'yet to start' ELSE a.model_load_status END",
        "CASE WHEN a.end_ts IS NULL THEN NULL ELSE a.start_ts END",
        "a.end_ts",
    ),
    "audit_start": _entered(
        "running", f"TIMESTAMP '{NOW[0]}'", _STARTED, f"TIMESTAMP '{NOW[0]}'", "NULL"
    ),
    "audit_reset": f"""
WITH {_AUDIT}
SELECT a.model_id, a.model_grp, a.inc_load_ts, a.pipeline_name, a.batch_id,
       CASE WHEN m.model_id IS NULL THEN a.model_load_status ELSE {_STARTED} END AS model_load_status,
       CASE WHEN m.model_id IS NULL THEN a.rows_inserted END AS rows_inserted,
       CASE WHEN m.model_id IS NULL THEN a.rows_updated END AS rows_updated,
       CASE WHEN m.model_id IS NULL THEN a.start_ts ELSE TIMESTAMP '{NOW[0]}' END AS start_ts,
       CASE WHEN m.model_id IS NULL THEN a.end_ts END AS end_ts, a.query_id, a.query_text
FROM audit a LEFT JOIN models m ON {_ON}""",
    "audit_lookup": f"""
WITH {_AUDIT}
SELECT m.pipeline_name, m.model_grp, m.model_id, m.batch_id,
       coalesce(a.inc_load_ts, TIMESTAMP '1900-01-01 00:00:00') AS inc_load_ts,
       coalesce(a.batch_id, '1900010101') AS recorded_batch_id,
       CASE WHEN a.model_id IS NULL THEN 'none' ELSE a.model_load_status END AS model_load_status,
       CAST(coalesce(a.rows_inserted, 0) AS BIGINT) AS rows_inserted,
       CAST(coalesce(a.rows_updated, 0) AS BIGINT) AS rows_updated
FROM models m LEFT JOIN audit a ON {_ON}""",
    "load_stats": f"WITH {_LOADED} SELECT batch_id, {_COUNTS} FROM loaded GROUP BY batch_id",
    "load_stats_one_batch": f"""
WITH {_LOADED}
SELECT 'known' AS batch, {_MAYBE} FROM loaded WHERE batch_id = '1998'
UNION ALL SELECT 'none', {_MAYBE} FROM loaded WHERE batch_id = '1901'""",
    "audit_complete": _completed(
        "CASE WHEN s.rows_updated > 20 THEN s.new_watermark "
        "ELSE TIMESTAMP '1994-01-01 00:00:00' END",
        "s.rows_inserted",
        "s.rows_updated",
        "'q1'",
        "'merge into items'",
    ),
    "audit_complete_full_reload": _completed("NULL", "s.all_rows", "0", "NULL", "NULL"),
    "schema_drift": f"WITH {_DRIFT} SELECT * FROM found",
    "schema_drift_log": f"""
WITH {_DRIFT},
earlier AS (
  SELECT CAST(p_size AS VARCHAR) AS model_id, 'old_' || CAST(p_partkey AS VARCHAR) AS column_name,
         CASE WHEN p_retailprice > 950 THEN '{BATCH[0]}' ELSE '{BATCH[1]}' END AS batch_id FROM part)
SELECT model_id, 'silver' AS model_grp, 'items' AS pipeline_name, 'raw.items' AS source_table,
       'silver.items' AS target_table, column_name, 'string' AS source_column_type,
       CAST(NULL AS VARCHAR) AS target_column_type, 'MISSING_IN_TARGET' AS diff_type, batch_id,
       TIMESTAMP '{NOW[0]}' AS etl_load_ts, TIMESTAMP '{NOW[0]}' AS etl_updt_ts
FROM earlier
WHERE NOT (batch_id = '{BATCH[1]}' AND model_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))
UNION ALL
SELECT model_id, 'silver', 'items', 'raw.items', 'silver.items', column_name, source_column_type,
       target_column_type, diff_type, '{BATCH[1]}', TIMESTAMP '{NOW[1]}', TIMESTAMP '{NOW[1]}'
FROM found""",
}
