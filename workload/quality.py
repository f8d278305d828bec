"""Data-quality configuration, rules and runs."""

from __future__ import annotations

import json
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import failure_ratio, result_status
from tidemark.functions.times import batch_number, moment
from tidemark.operators.quality import (
    RESULT_KEYS,
    Check,
    active_expectations,
    run_checks,
    run_quality,
    upsert_expectations,
    upsert_groups,
    upsert_projects,
    upsert_rules,
)
from tidemark.operators.replace import replace_rows
from tidemark.sources import schemas
from tidemark.sources.tables import empty, settle
from workload.common import BATCH, MARK, NOW, portable, table, text

# -------------------------------------------------------------- configuration


def _array_of(*fields):
    return F.to_json(F.array(F.struct(*fields))).alias("payload")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({"created_ts": moment(NOW[0]), "modified_ts": moment(NOW[0])})


def dq_config_projects(spark, folder):
    """Customers as projects: the known ones hold old owners, payloads bring all."""
    customers = table(spark, folder, "customer")
    key = text("c_custkey").alias("project_id")
    flag = F.when(F.col("c_acctbal") > 0, F.lit("Y")).otherwise("N").alias("active_flg")
    known = _stamped(
        customers.filter(F.col("c_acctbal") > 3000).select(
            key, F.lit("old").alias("project_name"), F.lit("nobody").alias("owner"), flag
        )
    )
    payloads = customers.select(
        _array_of(
            key, F.col("c_name").alias("project_name"), F.col("c_mktsegment").alias("owner"), flag
        )
    )
    return upsert_projects(known, payloads, NOW[1])


def dq_config_groups(spark, folder):
    """Orders as groups, two in each payload."""
    orders = table(spark, folder, "orders")

    def group(suffix: str):
        return F.struct(
            F.concat(text("o_orderkey"), F.lit(suffix)).alias("group_id"),
            F.col("o_orderpriority").alias("group_name"),
            text("o_custkey").alias("project_id"),
        )

    known = _stamped(
        orders.filter(F.col("o_orderstatus") == "F").select(
            F.concat(text("o_orderkey"), F.lit("a")).alias("group_id"),
            F.lit("old").alias("group_name"),
            F.lit("0").alias("project_id"),
        )
    )
    payloads = orders.select(F.to_json(F.array(group("a"), group("b"))).alias("payload"))
    return upsert_groups(known, payloads, NOW[1])


def dq_config_rules(spark, folder):
    """Parts as rules; some payloads name a field only, or not at all."""
    parts = table(spark, folder, "part")
    known = _stamped(
        parts.filter(F.col("p_size") > 20).select(
            text("p_partkey").alias("rule_id"),
            *[
                F.lit("old").alias(c)
                for c in (
                    "rule_name",
                    "rule_description",
                    "rule_type",
                    "dbt_test",
                    "param_attrib",
                    "expected_value",
                )
            ],
        )
    )
    payloads = parts.select(
        _array_of(
            text("p_partkey").alias("rule_id"),
            F.col("p_name").alias("rule_name"),
            F.concat(F.lit("it's "), "p_type").alias("rule_description"),
            F.col("p_type").alias("rule_type"),
            F.nullif(F.col("p_brand"), F.lit("Brand#2")).alias("dbt_test"),
            # A number in the payload is read as its text.
            F.col("p_size").alias("param_attrib"),
        )
    )
    return upsert_rules(known, payloads, NOW[1])


_EXPECTED = (
    "exp_type exp_message exp_dt severity_level source_system escalation_poc active_flg "
    "schema_name tbl_name full_tbl_name col_name param_value"
).split()


def dq_config_expectations(spark, folder):
    """Orders as expectations; a known one keeps its group."""
    orders = table(spark, folder, "orders")
    key = text("o_orderkey").alias("exp_id")
    known = _stamped(
        orders.filter(F.col("o_orderpriority") != "5-LOW").select(
            key, F.lit("first group").alias("group_id"), *[F.lit("old").alias(c) for c in _EXPECTED]
        )
    )
    parameters = F.to_json(F.struct(F.col("o_custkey").alias("table_name")))
    payloads = orders.select(
        _array_of(
            key,
            text("o_custkey").alias("group_id"),
            F.lit("check").alias("exp_type"),
            F.concat(F.lit('say "'), "o_orderpriority", F.lit('"')).alias("exp_message"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("exp_dt"),
            F.col("o_orderpriority").alias("severity_level"),
            F.lit("orders").alias("source_system"),
            F.lit("desk").alias("escalation_poc"),
            F.when(F.col("o_orderstatus") == "O", F.lit("Y")).otherwise("N").alias("active_flg"),
            F.lit("silver").alias("schema_name"),
            F.lit("orders_t").alias("tbl_name"),
            F.lit("db.silver.orders_t").alias("full_tbl_name"),
            F.col("o_orderstatus").alias("col_name"),
            parameters.alias("param_value"),
        )
    )
    return upsert_expectations(known, payloads, NOW[1])


def dq_active_expectations(spark, folder):
    """Expectations from orders, rules from items, groups from customers, projects: nations."""
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    expectations = orders.select(
        text("o_orderkey").alias("exp_id"),
        text("o_custkey").alias("group_id"),
        F.col("o_orderpriority").alias("exp_message"),
        F.when(F.col("o_orderstatus") != "F", F.lit("Y")).otherwise("N").alias("active_flg"),
        *[
            F.lit(c).alias(c)
            for c in _EXPECTED
            if c not in ("exp_type", "exp_message", "active_flg")
        ],
    )
    rules = items.groupBy(text("l_orderkey").alias("rule_id")).agg(
        F.max("l_returnflag").alias("rule_name"),
        F.min("l_linestatus").alias("rule_type"),
        F.count(F.lit(1)).cast("string").alias("dbt_test"),
    )
    groups = table(spark, folder, "customer").select(
        text("c_custkey").alias("group_id"),
        F.col("c_name").alias("group_name"),
        text("c_nationkey").alias("project_id"),
    )
    projects = table(spark, folder, "nation").select(
        text("n_nationkey").alias("project_id"), F.col("n_name").alias("project_name")
    )
    return active_expectations(expectations, rules, groups, projects)


# ---------------------------------------------------------------------- rules


def _tables(spark, folder) -> dict[str, DataFrame]:
    """Payments and applications with missing values, in two batches; history of orders."""
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")

    def batch(ts: str):
        late = F.col(ts) > moment(MARK[1])
        return batch_number(F.when(late, F.lit(BATCH[1])).otherwise(F.lit(BATCH[0])))

    payments = items.select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("payment_id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("flag_text"),
        F.col("l_shipdate").alias("ship_ts"),
        batch("l_shipdate").alias("batch_id"),
    )
    applications = orders.select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("start_ts"),
        F.when(F.col("o_orderstatus") != "F", F.lit("Y")).otherwise("N").alias("active_flg"),
        batch("o_orderdate").alias("batch_id"),
    )
    # Referenced applications: the urgent ones have been removed.
    kept = orders.filter(F.col("o_orderpriority") != "1-URGENT").select("o_orderkey")
    return {"payments": payments, "applications": applications, "kept": kept}


_RULES = {
    "not_null": [
        {"table_name": "payments", "column_name": "flag_id"},
        {"table_name": "applications", "column_name": "priority"},
        {"table_name": "applications", "column_name": "o_orderkey"},
    ],
    "not_null_id_vs_desc": [
        {"table_name": "payments", "id_column": "flag_id", "desc_column": "flag_text"},
        {"table_name": "applications", "id_column": "priority", "desc_column": "status"},
    ],
    "attribute_length_check": [
        {"table_name": "applications", "column_name": "priority", "min_length": 6, "max_length": 8},
        {"table_name": "payments", "column_name": "payment_id", "max_length": 6},
    ],
    "attribute_within_range_check": [
        {"table_name": "payments", "column_name": "quantity", "min_value": 5, "max_value": 45},
        {"table_name": "payments", "column_name": "amount", "min_value": 1000.5},
    ],
    "column_value_compare": [
        {
            "table_name": "payments",
            "column_name": "amount",
            "operator": ">",
            "compare_column": "quantity",
        },
        {
            "table_name": "payments",
            "column_name": "flag_id",
            "operator": "!=",
            "compare_column": "flag_text",
        },
    ],
    "conditional_null": [
        {"table_name": "applications", "column_name": "priority", "condition": "status = 'F'"},
    ],
    "date_consistency": [
        {"table_name": "history", "start_column": "start_ts", "end_column": "end_ts"},
    ],
    "referential_integrity": [
        {
            "table_name": "payments",
            "column_name": "l_orderkey",
            "ref_table": "kept",
            "ref_column": "o_orderkey",
        },
    ],
    "regex_check": [
        {"table_name": "applications", "column_name": "priority", "pattern": "^[12]-[A-Z]+$"},
        {"table_name": "payments", "column_name": "payment_id", "pattern": "^\\d+-[1-5]$"},
    ],
    "scd2_change_in_attribute_value": [
        {
            "table_name": "applications",
            "key_column": "o_custkey",
            "order_column": "start_ts, o_orderkey",
            "column_name": "priority",
        },
    ],
    "unexpected_values": [
        {"table_name": "applications", "column_name": "status", "allowed_values": ["O", "X's"]},
    ],
    "unique": [
        {"table_name": "payments", "key_column": "['l_orderkey', 'l_linenumber']"},
        {"table_name": "payments", "column_name": "flag_id"},
        {"table_name": "applications", "key_column": ["o_orderkey"]},
    ],
    "unique_typ2": [
        {"table_name": "applications", "key_column": "o_custkey"},
    ],
    "value_comparision_check": [
        {"table_name": "applications", "column_name": "status", "operator": "=", "value": "F"},
        {"table_name": "payments", "column_name": "amount", "operator": "<=", "value": 50000},
    ],
}


def _with_history(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Applications with an end that for some lies before the start, or is missing."""
    days = F.when(F.col("status") == "F", F.expr("INTERVAL 2 DAYS")).when(
        F.col("priority").isNotNull(), F.expr("-INTERVAL 1 DAY")
    )
    history = tables["applications"].withColumn("end_ts", F.col("start_ts") + days)
    return {**tables, "history": history}


def _rule_query(rule: str, spark, folder):
    """All expectations for one rule, over both batches."""
    checks = [
        Check(f"{rule}_{i}", f"dq_rule_{rule}", params) for i, params in enumerate(_RULES[rule])
    ]
    counts = run_checks(checks, _with_history(_tables(spark, folder)))
    failed, total = F.col("failure_record_count"), F.col("total_record_count")
    return counts.select(
        "exp_id",
        "total_record_count",
        "failure_record_count",
        failure_ratio(failed, total).alias("failure_ratio"),
        result_status(failed).alias("result_status"),
    )


# ------------------------------------------------------------------------ run


def _configured(spark) -> DataFrame:
    """Every rule as configured expectations of one project, and three that do not run."""
    now = NOW[0]
    rows = [
        (f"{rule}_{i}", f"dq_rule_{rule}", params, "Y")
        for rule, all_params in _RULES.items()
        for i, params in enumerate(all_params)
    ]
    rows.append(("retired", "dq_rule_not_null", _RULES["not_null"][0], "N"))
    rows.append(("unknown", "dq_rule_no_such_rule", _RULES["not_null"][0], "Y"))
    rules = [
        {"rule_id": e, "rule_name": f"rule {e}", "rule_type": "check", "dbt_test": test}
        for e, test, _, _ in rows
    ]
    expectations = [
        {
            "exp_id": e,
            "group_id": "g1",
            "exp_message": f"look at {e}",
            "severity_level": "high",
            "source_system": "items",
            "escalation_poc": "desk",
            "active_flg": flag,
            "schema_name": "silver",
            "tbl_name": params["table_name"],
            "full_tbl_name": f"db.silver.{params['table_name']}",
            "col_name": params.get("column_name"),
            "param_value": json.dumps(params),
        }
        for e, _, params, flag in rows
    ]
    groups = [{"group_id": "g1", "group_name": "payments", "project_id": "p1"}]
    projects = [{"project_id": "p1", "project_name": "loans", "owner": "desk", "active_flg": "Y"}]

    def payload(objects):
        return spark.range(1).select(F.lit(json.dumps(objects)).alias("payload"))

    return active_expectations(
        upsert_expectations(empty(spark, schemas.DQ_EXPECTATION), payload(expectations), now),
        upsert_rules(empty(spark, schemas.DQ_RULE), payload(rules), now),
        upsert_groups(empty(spark, schemas.DQ_GROUP), payload(groups), now),
        upsert_projects(empty(spark, schemas.DQ_PROJECT), payload(projects), now),
        "loans",
    )


def dq_run_results(spark, folder):
    """Results of both batches; the second batch is run again and replaces its rows."""
    tables = _with_history(_tables(spark, folder))
    expectations = settle(_configured(spark))
    first = settle(run_quality(expectations, tables, BATCH[0], NOW[0]))
    # What an earlier, wrong run left under the second batch.
    stale = first.withColumn("batch_id", batch_number(BATCH[1]))
    again = settle(run_quality(expectations, tables, BATCH[1], NOW[2]))
    results = replace_rows(first.unionByName(stale), again, RESULT_KEYS)
    return portable(results.drop("failure_record_query"))


def dq_failing_rows(spark, folder):
    """Rows that the failing-row query of every expectation gives, per expectation."""
    tables = _with_history(_tables(spark, folder))
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    checks = [
        Check(f"{rule}_{i}", f"dq_rule_{rule}", params)
        for rule, all_params in _RULES.items()
        for i, params in enumerate(all_params)
    ]
    queries = run_checks(checks, tables).select("exp_id", "failure_record_query").collect()
    counts = [
        spark.sql(r["failure_record_query"]).agg(
            F.lit(r["exp_id"]).alias("exp_id"), F.count(F.lit(1)).alias("failing_rows")
        )
        for r in queries
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES = {
    "dq_config_projects": dq_config_projects,
    "dq_config_groups": dq_config_groups,
    "dq_config_rules": dq_config_rules,
    "dq_config_expectations": dq_config_expectations,
    "dq_active_expectations": dq_active_expectations,
    **{f"dq_{rule}": partial(_rule_query, rule) for rule in _RULES},
    "dq_run_results": dq_run_results,
    "dq_failing_rows": dq_failing_rows,
}

# ------------------------------------------------------------------------- SQL

_TABLES = f"""
payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
         l_orderkey, l_linenumber, l_extendedprice AS amount, l_quantity AS quantity,
         nullif(l_returnflag, 'R') AS flag_id,
         CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS flag_text, l_shipdate AS ship_ts,
         CASE WHEN l_shipdate > TIMESTAMP '{MARK[1]}' THEN '{BATCH[1]}' ELSE '{BATCH[0]}' END AS batch_id
  FROM lineitem),
applications AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS priority,
         nullif(o_orderstatus, 'P') AS status, o_totalprice AS amount, o_orderdate AS start_ts,
         CASE WHEN o_orderstatus <> 'F' THEN 'Y' ELSE 'N' END AS active_flg,
         CASE WHEN o_orderdate > TIMESTAMP '{MARK[1]}' THEN '{BATCH[1]}' ELSE '{BATCH[0]}' END AS batch_id,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY
              WHEN o_orderpriority <> '5-LOW' THEN o_orderdate - INTERVAL 1 DAY END AS end_ts
  FROM orders),
kept AS (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT'),
marked_payments AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS line_copies,
         count(*) OVER (PARTITION BY flag_id) AS flag_copies,
         l_orderkey NOT IN (SELECT o_orderkey FROM kept) AS orphan
  FROM payments),
marked_applications AS (
  SELECT *, lag(coalesce(priority, '~')) OVER (PARTITION BY o_custkey ORDER BY start_ts, o_orderkey)
           = coalesce(priority, '~') AS unchanged,
         count(*) OVER (PARTITION BY o_orderkey) AS key_copies,
         count(*) FILTER (active_flg = 'Y') OVER (PARTITION BY o_custkey) AS active_copies
  FROM applications)"""

# Failing rows of every expectation in _RULES.
_FAILS = {
    "not_null": [
        ("payments", "flag_id IS NULL"),
        ("applications", "priority IS NULL"),
        ("applications", "o_orderkey IS NULL"),
    ],
    "not_null_id_vs_desc": [
        ("payments", "(flag_id IS NULL) <> (flag_text IS NULL)"),
        ("applications", "(priority IS NULL) <> (status IS NULL)"),
    ],
    "attribute_length_check": [
        ("applications", "length(priority) < 6 OR length(priority) > 8"),
        ("payments", "length(payment_id) > 6"),
    ],
    "attribute_within_range_check": [
        ("payments", "quantity < 5 OR quantity > 45"),
        ("payments", "amount < 1000.5"),
    ],
    "column_value_compare": [
        ("payments", "NOT (amount > quantity)"),
        ("payments", "flag_id = flag_text"),
    ],
    "conditional_null": [("applications", "status = 'F' AND priority IS NULL")],
    "date_consistency": [("applications", "start_ts > end_ts")],
    "referential_integrity": [("payments", "orphan")],
    "regex_check": [
        ("applications", "NOT regexp_matches(priority, '^[12]-[A-Z]+$')"),
        ("payments", "NOT regexp_matches(payment_id, '^[0-9]+-[1-5]$')"),
    ],
    "scd2_change_in_attribute_value": [("applications", "unchanged")],
    "unexpected_values": [("applications", "status <> 'O'")],
    "unique": [
        ("payments", "line_copies > 1"),
        ("payments", "flag_id IS NOT NULL AND flag_copies > 1"),
        ("applications", "key_copies > 1"),
    ],
    "unique_typ2": [("applications", "active_flg = 'Y' AND active_copies > 1")],
    "value_comparision_check": [
        ("applications", "status <> 'F'"),
        ("payments", "amount > 50000"),
    ],
}


def _scores() -> str:
    return """CASE WHEN total > 0 THEN CAST(failed AS DOUBLE) / CAST(total AS DOUBLE) * 100.0
       ELSE 0.0 END AS failure_ratio,
       CASE WHEN failed > 0 THEN 'Fail' ELSE 'Success' END AS result_status"""


def _counts(rule: str, by_batch: bool = False) -> str:
    batch = "batch_id, " if by_batch else ""
    group = " GROUP BY batch_id" if by_batch else ""
    return " UNION ALL ".join(
        f"SELECT '{rule}_{i}' AS exp_id, {batch}count(*) AS total, "
        f"count(*) FILTER ({fails}) AS failed FROM marked_{name}{group}"
        for i, (name, fails) in enumerate(_FAILS[rule])
    )


def _rule_sql(rule: str) -> str:
    return f"""
WITH {_TABLES}, counts AS ({_counts(rule)})
SELECT exp_id, total AS total_record_count, failed AS failure_record_count, {_scores()}
FROM counts"""


def _config_values() -> str:
    """Descriptive columns of every expectation."""
    rows = []
    for rule, all_params in _RULES.items():
        for i, params in enumerate(all_params):
            keys = params.get("key_column") or []
            if isinstance(keys, str):
                keys = keys.replace("[", "").replace("]", "").replace("'", "").split(", ")
            key_text = f"'{', '.join(keys)}'" if keys else "NULL"
            column = params.get("column_name")
            column_text = f"'{column}'" if column else "NULL"
            rows.append(
                f"('{rule}_{i}', 'dq_rule_{rule}', '{params['table_name']}', {key_text}, {column_text})"
            )
    return ", ".join(rows)


def _upsert_sql(key: str, known: str, source: str, fields: list[str], fixed: str = "") -> str:
    out = []
    for f in fields:
        if f == fixed:
            value = f"CASE WHEN t.{key} IS NULL THEN s.{f} ELSE t.{f} END"
        else:
            value = f"CASE WHEN s.{key} IS NULL THEN t.{f} ELSE s.{f} END"
        out.append(f"{value} AS {f}")
    return f"""
WITH t AS ({known}), s AS ({source})
SELECT coalesce(s.{key}, t.{key}) AS {key}, {', '.join(out)},
       CASE WHEN t.{key} IS NULL THEN TIMESTAMP '{NOW[1]}' ELSE TIMESTAMP '{NOW[0]}' END AS created_ts,
       CASE WHEN s.{key} IS NULL THEN TIMESTAMP '{NOW[0]}' ELSE TIMESTAMP '{NOW[1]}' END AS modified_ts
FROM t FULL JOIN s ON t.{key} = s.{key}"""


_RULE_FIELDS = (
    "rule_name rule_description rule_type dbt_test param_attrib expected_value".split()
)

SQL = {
    "dq_config_projects": _upsert_sql(
        "project_id",
        "SELECT CAST(c_custkey AS VARCHAR) AS project_id, 'old' AS project_name, 'nobody' AS owner, "
        "CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS active_flg FROM customer WHERE c_acctbal > 3000",
        "SELECT CAST(c_custkey AS VARCHAR) AS project_id, c_name AS project_name, "
        "c_mktsegment AS owner, CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS active_flg FROM customer",
        ["project_name", "owner", "active_flg"],
    ),
    "dq_config_groups": _upsert_sql(
        "group_id",
        "SELECT CAST(o_orderkey AS VARCHAR) || 'a' AS group_id, 'old' AS group_name, "
        "'0' AS project_id FROM orders WHERE o_orderstatus = 'F'",
        "SELECT CAST(o_orderkey AS VARCHAR) || x.suffix AS group_id, o_orderpriority AS group_name, "
        "CAST(o_custkey AS VARCHAR) AS project_id FROM orders, (VALUES ('a'), ('b')) x(suffix)",
        ["group_name", "project_id"],
    ),
    "dq_config_rules": _upsert_sql(
        "rule_id",
        "SELECT CAST(p_partkey AS VARCHAR) AS rule_id, "
        + ", ".join(f"'old' AS {f}" for f in _RULE_FIELDS)
        + " FROM part WHERE p_size > 20",
        "SELECT CAST(p_partkey AS VARCHAR) AS rule_id, p_name AS rule_name, "
        "'it''s ' || p_type AS rule_description, p_type AS rule_type, "
        "nullif(p_brand, 'Brand#2') AS dbt_test, CAST(p_size AS VARCHAR) AS param_attrib, "
        "CAST(NULL AS VARCHAR) AS expected_value FROM part",
        _RULE_FIELDS,
    ),
    "dq_config_expectations": _upsert_sql(
        "exp_id",
        "SELECT CAST(o_orderkey AS VARCHAR) AS exp_id, 'first group' AS group_id, "
        + ", ".join(f"'old' AS {f}" for f in _EXPECTED)
        + " FROM orders WHERE o_orderpriority <> '5-LOW'",
        """SELECT CAST(o_orderkey AS VARCHAR) AS exp_id, CAST(o_custkey AS VARCHAR) AS group_id,
         'check' AS exp_type, 'say "' || o_orderpriority || '"' AS exp_message,
         strftime(o_orderdate, '%Y-%m-%d') AS exp_dt, o_orderpriority AS severity_level,
         'orders' AS source_system, 'desk' AS escalation_poc,
         CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS active_flg,
         'silver' AS schema_name, 'orders_t' AS tbl_name, 'db.silver.orders_t' AS full_tbl_name,
         o_orderstatus AS col_name,
         '{"table_name":' || CAST(o_custkey AS VARCHAR) || '}' AS param_value FROM orders""",
        ["group_id", *_EXPECTED],
        fixed="group_id",
    ),
    "dq_active_expectations": """
WITH rules AS (
  SELECT l_orderkey, max(l_returnflag) AS rule_name, min(l_linestatus) AS rule_type,
         CAST(count(*) AS VARCHAR) AS dbt_test
  FROM lineitem GROUP BY l_orderkey)
SELECT CAST(n_nationkey AS VARCHAR) AS project_id, n_name AS project_name,
       CAST(c_custkey AS VARCHAR) AS group_id, c_name AS group_name,
       CAST(l_orderkey AS VARCHAR) AS rule_id, rule_name, rule_type, dbt_test,
       CAST(o_orderkey AS VARCHAR) AS exp_id, o_orderpriority AS exp_message,
       'param_value' AS param_value, 'schema_name' AS schema_name, 'tbl_name' AS tbl_name,
       'full_tbl_name' AS full_tbl_name, 'col_name' AS col_name, 'exp_dt' AS exp_dt,
       'severity_level' AS severity_level, 'source_system' AS source_system,
       'escalation_poc' AS escalation_poc, 'Y' AS active_flg
FROM orders JOIN rules ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus <> 'F'""",
    **{f"dq_{rule}": _rule_sql(rule) for rule in _RULES},
    "dq_failing_rows": f"""
WITH {_TABLES}, counts AS ({' UNION ALL '.join(_counts(rule) for rule in _RULES)})
SELECT exp_id, failed AS failing_rows FROM counts""",
    "dq_run_results": f"""
WITH {_TABLES},
counts AS ({' UNION ALL '.join(_counts(rule, by_batch=True) for rule in _RULES)}),
config(exp_id, dbt_test, tbl_name, key_column, col_name) AS (VALUES {_config_values()})
SELECT 'p1' AS project_id, 'loans' AS project_name, 'g1' AS group_id, 'payments' AS group_name,
       exp_id AS rule_id, 'rule ' || exp_id AS rule_name, 'check' AS rule_type, dbt_test, exp_id,
       'look at ' || exp_id AS exp_message, 'silver' AS dq_rule_schema_name, tbl_name,
       'db.silver.' || tbl_name AS full_tbl_name, key_column, col_name,
       CASE batch_id WHEN '{BATCH[0]}' THEN '{NOW[0].replace(" ", "T")}'
            ELSE '{NOW[2].replace(" ", "T")}' END AS rule_execution_ts,
       {_scores()}, failed AS failure_record_count, total AS total_record_count,
       'high' AS severity_level, 'items' AS source_system, 'desk' AS escalation_poc, batch_id,
       CASE batch_id WHEN '{BATCH[0]}' THEN TIMESTAMP '{NOW[0]}' ELSE TIMESTAMP '{NOW[2]}' END
         AS etl_load_ts,
       CASE batch_id WHEN '{BATCH[0]}' THEN TIMESTAMP '{NOW[0]}' ELSE TIMESTAMP '{NOW[2]}' END
         AS etl_updt_ts
FROM counts JOIN config USING (exp_id)""",
}
