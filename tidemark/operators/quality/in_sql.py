"""Rules for SQL text: a table function of the rows that fail one."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from tidemark.operators.quality.rules import GROUP_QUERIES, ROW_RULES
from tidemark.sources.tables import checked_name


def failing_rows(rule: str, params: Mapping[str, Any]) -> str:
    """The query for the rows of ``params["table_name"]`` that a rule counts as failed."""
    table = params["table_name"]
    if rule in ROW_RULES:
        return f"SELECT * FROM {table} WHERE {ROW_RULES[rule](params)}"
    if rule in GROUP_QUERIES:
        return GROUP_QUERIES[rule](table, params, "")
    raise ValueError(f"unknown rule {rule!r}")


def register_rule(spark: SparkSession, name: str, rule: str, params: Mapping[str, Any]) -> None:
    """Make ``name()`` a table function of the session: the rows that fail ``rule``.

    The tables that ``params`` name are tables or views of the session. Spark inlines the
    function, so a condition on its rows reaches their scan. An unknown rule, a missing
    table or a missing column is an error here, not when the function is called.
    """
    query = failing_rows(rule, params)
    columns = ", ".join(
        f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in spark.sql(query).schema.fields
    )
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {checked_name(name)}() RETURNS TABLE ({columns}) RETURN {query}")
