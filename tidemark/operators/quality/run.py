"""Run configured data-quality checks: one pass per table for all its row rules."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scores import failure_ratio, result_status
from tidemark.functions.times import batch_number, iso_text, moment
from tidemark.operators.quality.rules import (
    GROUP_QUERIES,
    GROUP_RULES,
    ROW_RULES,
    UNIQUE_RULES,
    key_list,
    repeated,
    unique_keys,
)
from tidemark.sources.tables import empty

# Row rules per aggregate; more rules on a table take another pass.
RULES_PER_PASS = 100

# Result of a check that could not be run.
ERROR = "Error"

RESULT_KEYS = ["project_id", "group_id", "rule_id", "exp_id", "batch_id"]


@dataclass(frozen=True)
class Check:
    """One expectation to run: an id, the rule's registered name, and its parameters."""

    exp_id: str
    rule: str
    params: Mapping[str, Any]


COUNTS = (
    "exp_id string, total_record_count bigint, failure_record_count bigint, "
    "failure_record_query string, key_column string"
)


def run_checks(
    checks: list[Check],
    tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
    batch_id=None,
) -> DataFrame | None:
    """(exp_id, total_record_count, failure_record_count, failure_record_query, key_column).

    With ``batch_id`` only that batch's rows count. Checks with an unknown rule are left
    out; one whose table, columns or parameters are wrong gets a row without counts that
    says why in place of the query. Ids must differ. None when nothing is left to run.
    """
    _refuse_repeats([c.exp_id for c in checks])
    table_of = tables if callable(tables) else tables.__getitem__
    by_table: dict[str, list[tuple[Check, str]]] = {}
    by_key: dict[tuple[str, tuple[str, ...]], list[Check]] = {}
    parts: list[DataFrame] = []
    wrong: list[tuple[Check, str]] = []
    for check in checks:
        name = check.params.get("table_name")
        try:
            if check.rule in ROW_RULES:
                predicate = ROW_RULES[check.rule](check.params)
                _in_one_batch(table_of(name), batch_id).select(F.expr(predicate))  # analysed at once
                by_table.setdefault(name, []).append((check, predicate))
            elif check.rule in UNIQUE_RULES:
                keys = tuple(unique_keys(check.params))
                repeated(table_of(name), _in_batch(batch_id), list(keys), [UNIQUE_RULES[check.rule]])
                by_key.setdefault((name, keys), []).append(check)
            elif check.rule in GROUP_RULES:
                table = table_of(name)
                counts = GROUP_RULES[check.rule](table, _in_batch(batch_id), check.params, table_of)
                parts.append(
                    counts.select(
                        F.lit(check.exp_id).alias("exp_id"),
                        F.col("total").alias("total_record_count"),
                        F.col("failed").alias("failure_record_count"),
                        F.lit(_group_query(check, batch_id)).alias("failure_record_query"),
                        _key_text(check).alias("key_column"),
                    )
                )
        except (KeyError, ValueError, TypeError, AttributeError, PySparkException) as error:
            wrong.append((check, f"-- {type(error).__name__}: {str(error).splitlines()[0][:500]}"))
    for name, rules in by_table.items():
        for start in range(0, len(rules), RULES_PER_PASS):
            part = rules[start : start + RULES_PER_PASS]
            parts.append(_row_rules_pass(table_of(name), name, part, batch_id))
    for (name, keys), shared in by_key.items():
        counted = repeated(
            table_of(name), _in_batch(batch_id), list(keys), [UNIQUE_RULES[c.rule] for c in shared]
        )
        parts.append(_inlined(counted, [(c, f"f{i}", _group_query(c, batch_id)) for i, c in enumerate(shared)]))
    if wrong:
        spark = SparkSession.active()
        parts.append(spark.createDataFrame([(c.exp_id, None, None, why, None) for c, why in wrong], COUNTS))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _refuse_repeats(ids: list[str]) -> None:
    repeats = sorted(i for i, n in Counter(ids).items() if n > 1)
    if repeats:
        raise ValueError(f"several expectations have the id {repeats}")


def _parsed(text: str | None) -> Mapping[str, Any]:
    """Parameters of an expectation; none where the text is no JSON object."""
    try:
        value = json.loads(text or "")
    except ValueError:
        return {}
    return value if isinstance(value, dict) else {}


def run_quality(
    expectations: DataFrame,
    tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
    batch_id,
    now,
    *,
    slice_batch: bool = True,
) -> DataFrame:
    """Result rows for the expectations (as ``active_expectations`` gives them).

    The expectations are configuration, a few rows per checked table; only their ids,
    rule names and parameters come to the driver. Counts stay in Spark.
    """
    wanted = expectations.select("exp_id", "dbt_test", "param_value").collect()
    checks = [Check(r["exp_id"], r["dbt_test"], _parsed(r["param_value"])) for r in wanted]
    counts = run_checks(checks, tables, batch_id if slice_batch else None)
    if counts is None:
        counts = empty(expectations.sparkSession, COUNTS)
    failed, total = F.col("failure_record_count"), F.col("total_record_count")
    return expectations.join(counts, "exp_id").select(
        "project_id",
        "project_name",
        "group_id",
        "group_name",
        "rule_id",
        "rule_name",
        "rule_type",
        "dbt_test",
        "exp_id",
        "exp_message",
        F.col("schema_name").alias("dq_rule_schema_name"),
        "tbl_name",
        "full_tbl_name",
        "key_column",
        "col_name",
        iso_text(moment(now)).alias("rule_execution_ts"),
        F.when(total.isNull(), F.lit(ERROR)).otherwise(result_status(failed)).alias("result_status"),
        "failure_record_count",
        "total_record_count",
        failure_ratio(failed, total).alias("failure_ratio"),
        "failure_record_query",
        "severity_level",
        "source_system",
        "escalation_poc",
        batch_number(batch_id).alias("batch_id"),
        moment(now).alias("etl_load_ts"),
        moment(now).alias("etl_updt_ts"),
    )


def _row_rules_pass(
    table: DataFrame, name: str, rules: list[tuple[Check, str]], batch_id
) -> DataFrame:
    counted = _in_one_batch(table, batch_id).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.expr(rule)).alias(f"f{i}") for i, (_, rule) in enumerate(rules)],
    )
    where = _batch_text(batch_id)
    return _inlined(
        counted,
        [(c, f"f{i}", f"SELECT * FROM {name} WHERE {where}({rule})") for i, (c, rule) in enumerate(rules)],
    )


def _inlined(counted: DataFrame, checks: list[tuple[Check, str, str]]) -> DataFrame:
    """A result row for each check, from the one row with all counts."""
    rows = [
        F.struct(
            F.lit(check.exp_id).alias("exp_id"),
            F.col("total").alias("total_record_count"),
            F.col(failed).alias("failure_record_count"),
            F.lit(query).alias("failure_record_query"),
            _key_text(check).alias("key_column"),
        )
        for check, failed, query in checks
    ]
    return counted.select(F.inline(F.array(*rows)))


def _group_query(check: Check, batch_id) -> str:
    return GROUP_QUERIES[check.rule](check.params["table_name"], check.params, _batch_text(batch_id))


def _batch_text(batch_id) -> str:
    return "" if batch_id is None else f"batch_id = {batch_id} AND "


def _in_one_batch(table: DataFrame, batch_id) -> DataFrame:
    return table if batch_id is None else table.filter(_in_batch(batch_id))


def _in_batch(batch_id) -> Column:
    if batch_id is None:
        return F.lit(True)
    return F.coalesce(F.col("batch_id") == batch_number(batch_id), F.lit(False))


def _key_text(check: Check) -> Column:
    keys = key_list(check.params.get("key_column"))
    return F.lit(", ".join(keys) if keys else None).cast("string")
