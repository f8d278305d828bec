"""The merge in all its modes, history close-out, and replacing a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import batch_number, moment
from tidemark.operators.history import close_intervals, close_out, settle_reporting
from tidemark.operators.merge import merge
from tidemark.operators.replace import replace_rows
from tidemark.sources.tables import settle
from workload.common import BATCH, MARK, NOW, portable, table, text


def _customer_state(spark, folder, late: bool, keys=("cust_id",)) -> DataFrame:
    """Order totals per customer and priority, from orders up to the mark or after it.

    The status key is NULL or empty for two of the three order states.
    """
    orders = table(spark, folder, "orders")
    after = F.col("o_orderdate") > moment(MARK[1])
    run = 1 if late else 0
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(None))
        .when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.col("o_orderstatus"))
    )
    rows = orders.filter(after if late else ~after).select(
        F.concat_ws(":", text("o_custkey"), "o_orderpriority").alias("cust_id"),
        status.alias("status"),
        "*",
    )
    return rows.groupBy(*keys).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.count(F.lit(1)).alias("order_count"),
        F.max("o_orderdate").alias("last_order_ts"),
        F.when(F.min("o_orderstatus") == "F", F.lit("Y"))
        .when(F.max("o_orderstatus") == "P", F.lit("N"))
        .alias("open_flg"),
        batch_number(BATCH[run]).alias("batch_id"),
        moment(NOW[run]).alias("etl_load_ts"),
        moment(NOW[run]).alias("etl_updt_ts"),
    )


def _merged(spark, folder, **options) -> DataFrame:
    target = _customer_state(spark, folder, late=False)
    source = settle(_customer_state(spark, folder, late=True))
    return portable(merge(target, source, "cust_id", **options))


def merge_upsert(spark, folder):
    return _merged(spark, folder)


def merge_exclude_columns(spark, folder):
    return _merged(spark, folder, exclude=["ETL_LOAD_TS", "total"])


def merge_partial_update(spark, folder):
    return _merged(spark, folder, update=["order_count", "etl_updt_ts"])


def merge_guarded(spark, folder):
    return _merged(spark, folder, guard="open_flg", exclude=["etl_load_ts"])


def merge_large_source(spark, folder):
    """The same merge in the form for an increment that cannot be broadcast."""
    return _merged(spark, folder, guard="open_flg", small_source=False)


def merge_expressions(spark, folder):
    """Running totals: values on a match are made of the old and the new row."""
    new = {
        "total": F.col("old.total") + F.col("new.total"),
        "order_count": F.col("old.order_count") + F.col("new.order_count"),
        "last_order_ts": F.greatest("old.last_order_ts", "new.last_order_ts"),
    }
    return _merged(spark, folder, expressions=new)


def merge_append_only(spark, folder):
    target = _customer_state(spark, folder, late=False)
    source = _customer_state(spark, folder, late=True)
    return portable(merge(target, source, None))


def merge_composite_null_safe(spark, folder):
    """Two keys, one of them NULL or empty in many rows: those rows never match."""
    keys = ["cust_id", "status"]
    target = _customer_state(spark, folder, late=False, keys=keys)
    source = settle(_customer_state(spark, folder, late=True, keys=keys))
    return portable(merge(target, source, keys))


def merge_latest_duplicate(spark, folder):
    """Several source rows per key: the newest one counts."""
    orders = table(spark, folder, "orders").select(
        text("o_custkey").alias("cust_id"),
        text("o_orderkey").alias("order_id"),
        "o_orderstatus",
        "o_orderdate",
    )
    after = F.col("o_orderdate") > moment(MARK[1])
    target = orders.filter(~after).groupBy("cust_id").agg(
        F.lit("none").alias("order_id"),
        F.min("o_orderstatus").alias("o_orderstatus"),
        F.min("o_orderdate").alias("o_orderdate"),
    )
    return merge(
        target,
        settle(orders.filter(after)),
        "cust_id",
        duplicates="latest",
        order_by=[F.desc("o_orderdate"), F.desc("order_id")],
    )


def _versions(spark, folder) -> DataFrame:
    """Orders as versions of a customer; finished ones are closed already."""
    orders = table(spark, folder, "orders")
    open_order = F.col("o_orderstatus") != "F"
    return orders.select(
        F.col("o_custkey").alias("sk"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").alias("start_ts"),
        F.when(~open_order, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("end_ts"),
        F.when(open_order, F.lit("Y")).otherwise(F.lit("N")).alias("active_flg"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("N")).otherwise("Y").alias(
            "reporting_flg"
        ),
    )


def scd2_close_out(spark, folder):
    return close_intervals(_versions(spark, folder), "sk", "seq")


def _status_versions(spark, folder) -> DataFrame:
    """The same versions, numbered by order status: one number recurs for a customer."""
    status = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
    )
    return (
        _versions(spark, folder)
        .join(status, F.col("seq") == F.col("order_id"))
        .select(
            "sk",
            F.concat_ws("|", "status", F.date_format("start_ts", "yyyy")).alias("seq"),
            "start_ts",
            "end_ts",
            "active_flg",
            "reporting_flg",
            "order_id",
        )
    )


def scd2_reporting_flags(spark, folder):
    return settle_reporting(_status_versions(spark, folder), "sk", "seq")


def scd2_close_out_both_steps(spark, folder):
    return close_out(_versions(spark, folder), "sk", "seq")


def replace_batch(spark, folder):
    """Yearly totals per supplier; batches with corrected rows are replaced whole."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supp_id"),
        F.year("l_shipdate").cast("string").alias("batch_id"),
        "l_returnflag",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    existing = items.groupBy("supp_id", "batch_id", "l_returnflag").agg(
        F.sum("price").alias("total"), F.lit("first").alias("run")
    )
    corrected = (
        items.filter(F.col("price") > 50000)
        .groupBy("supp_id", "batch_id", "l_returnflag")
        .agg(F.max("price").alias("total"), F.lit("second").alias("run"))
    )
    return portable(replace_rows(existing, corrected, ["supp_id", "batch_id"]))


QUERIES = {
    "merge_upsert": merge_upsert,
    "merge_exclude_columns": merge_exclude_columns,
    "merge_partial_update": merge_partial_update,
    "merge_guarded": merge_guarded,
    "merge_large_source": merge_large_source,
    "merge_expressions": merge_expressions,
    "merge_append_only": merge_append_only,
    "merge_composite_null_safe": merge_composite_null_safe,
    "merge_latest_duplicate": merge_latest_duplicate,
    "scd2_close_out": scd2_close_out,
    "scd2_reporting_flags": scd2_reporting_flags,
    "scd2_close_out_both_steps": scd2_close_out_both_steps,
    "replace_batch": replace_batch,
}

# ------------------------------------------------------------------------- SQL


def _state(late: bool, keys: str = "cust_id") -> str:
    run = 1 if late else 0
    return f"""
  SELECT {keys}, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS order_count,
         max(o_orderdate) AS last_order_ts,
         CASE WHEN min(o_orderstatus) = 'F' THEN 'Y'
              WHEN max(o_orderstatus) = 'P' THEN 'N' END AS open_flg,
         '{BATCH[run]}' AS batch_id, TIMESTAMP '{NOW[run]}' AS etl_load_ts,
         TIMESTAMP '{NOW[run]}' AS etl_updt_ts
  FROM (SELECT *, CAST(o_custkey AS VARCHAR) || ':' || o_orderpriority AS cust_id,
               CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN '' ELSE o_orderstatus END
                 AS status FROM orders)
  WHERE o_orderdate {'>' if late else '<='} TIMESTAMP '{MARK[1]}'
  GROUP BY {keys}"""


_COLUMNS = (
    "total order_count last_order_ts open_flg batch_id etl_load_ts etl_updt_ts".split()
)


def _full_join(old: tuple[str, ...] = (), exprs: dict[str, str] | None = None, on: str = "") -> str:
    """Matched rows take the source's values, but the target's for ``old``."""
    out = []
    for c in _COLUMNS:
        hit = (exprs or {}).get(c, f"t.{c}" if c in old else f"s.{c}")
        value = (
            f"CASE WHEN s.cust_id IS NULL THEN t.{c} WHEN t.cust_id IS NULL THEN s.{c} "
            f"ELSE {hit} END"
        )
        out.append(f"CAST({value} AS DOUBLE) AS total" if c == "total" else f"{value} AS {c}")
    return f"""
WITH t AS ({_state(False)}), s AS ({_state(True)})
SELECT coalesce(s.cust_id, t.cust_id) AS cust_id, {', '.join(out)}
FROM t FULL JOIN s ON t.cust_id = s.cust_id{on}"""


_GUARD = " AND t.open_flg = 'Y'"
_HELD = tuple(c for c in _COLUMNS if c not in ("order_count", "etl_updt_ts"))

_SUMMED = {c: f"t.{c}" for c in _COLUMNS} | {
    "total": "t.total + s.total",
    "order_count": "t.order_count + s.order_count",
    "last_order_ts": "greatest(t.last_order_ts, s.last_order_ts)",
}

_PAIR_OUT = ", ".join(
    f"CAST({{a}}.{c} AS DOUBLE) AS {c}" if c == "total" else f"{{a}}.{c}" for c in _COLUMNS
)

_VERSIONS = """
v AS (
  SELECT o_custkey AS sk, o_orderkey AS seq, o_orderdate AS start_ts,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS end_ts,
         CASE WHEN o_orderstatus <> 'F' THEN 'Y' ELSE 'N' END AS active_flg,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'N' ELSE 'Y' END AS reporting_flg,
         o_orderstatus
  FROM orders)"""

_CLOSED = """
n AS (
  SELECT sk, seq, lead(start_ts) OVER (PARTITION BY sk ORDER BY start_ts, seq) AS next_ts
  FROM v WHERE active_flg = 'Y'),
c AS (
  SELECT v.sk, v.seq, v.start_ts,
         CASE WHEN n.seq IS NULL THEN v.end_ts ELSE n.next_ts END AS end_ts,
         CASE WHEN n.seq IS NULL THEN v.active_flg
              WHEN n.next_ts IS NULL THEN 'Y' ELSE 'N' END AS active_flg,
         CASE WHEN n.seq IS NULL THEN v.reporting_flg
              WHEN n.next_ts IS NULL THEN 'Y' ELSE 'N' END AS reporting_flg
  FROM v LEFT JOIN n ON v.sk = n.sk AND v.seq = n.seq)"""

SQL = {
    "merge_upsert": _full_join(),
    "merge_exclude_columns": _full_join(("etl_load_ts", "total")),
    "merge_partial_update": _full_join(_HELD),
    "merge_guarded": _full_join(("etl_load_ts",), on=_GUARD),
    "merge_large_source": _full_join(on=_GUARD),
    "merge_expressions": _full_join(exprs=_SUMMED),
    "merge_append_only": f"""
WITH a AS ({_state(False)} UNION ALL {_state(True)})
SELECT cust_id, {_PAIR_OUT.format(a='a')} FROM a""",
    "merge_composite_null_safe": f"""
WITH t AS ({_state(False, 'cust_id, status')}), s AS ({_state(True, 'cust_id, status')})
SELECT t.cust_id, t.status, {_PAIR_OUT.format(a='t')} FROM t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cust_id = nullif(t.cust_id, '')
                    AND s.status = nullif(t.status, ''))
UNION ALL
SELECT s.cust_id, s.status, {_PAIR_OUT.format(a='s')} FROM s""",
    "merge_latest_duplicate": f"""
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS cust_id, CAST(o_orderkey AS VARCHAR) AS order_id,
                  o_orderstatus, o_orderdate FROM orders),
t AS (SELECT cust_id, 'none' AS order_id, min(o_orderstatus) AS o_orderstatus,
             min(o_orderdate) AS o_orderdate
      FROM o WHERE o_orderdate <= TIMESTAMP '{MARK[1]}' GROUP BY cust_id),
s AS (SELECT * FROM o WHERE o_orderdate > TIMESTAMP '{MARK[1]}'
      QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY o_orderdate DESC, order_id DESC) = 1)
SELECT * FROM s
UNION ALL
SELECT * FROM t WHERE cust_id NOT IN (SELECT cust_id FROM s)""",
    "scd2_close_out": f"WITH {_VERSIONS}, {_CLOSED} SELECT * FROM c",
    "scd2_close_out_both_steps": f"WITH {_VERSIONS}, {_CLOSED} SELECT * FROM c",
    "scd2_reporting_flags": f"""
WITH {_VERSIONS},
k AS (SELECT *, o_orderstatus || '|' || strftime(start_ts, '%Y') AS vseq FROM v),
m AS (SELECT sk, vseq, max(start_ts) AS last_ts FROM k WHERE reporting_flg = 'Y' GROUP BY 1, 2)
SELECT k.sk, k.vseq AS seq, k.start_ts, k.end_ts, k.active_flg,
       CASE WHEN k.reporting_flg = 'Y' AND k.start_ts < m.last_ts THEN 'N'
            ELSE k.reporting_flg END AS reporting_flg,
       k.seq AS order_id
FROM k LEFT JOIN m ON k.sk = m.sk AND k.vseq = m.vseq""",
    "replace_batch": """
WITH i AS (SELECT l_suppkey AS supp_id, strftime(l_shipdate, '%Y') AS batch_id, l_returnflag,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
e AS (SELECT supp_id, batch_id, l_returnflag, sum(price) AS total, 'first' AS run
      FROM i GROUP BY 1, 2, 3),
c AS (SELECT supp_id, batch_id, l_returnflag, max(price) AS total, 'second' AS run
      FROM i WHERE price > 50000 GROUP BY 1, 2, 3),
u AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.supp_id = e.supp_id
                                          AND c.batch_id = e.batch_id)
      UNION ALL SELECT * FROM c)
SELECT supp_id, batch_id, l_returnflag, CAST(total AS DOUBLE) AS total, run FROM u""",
}
