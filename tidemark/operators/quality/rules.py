"""Data-quality rules.

A row rule is a predicate that holds for a failing row; all row rules of a table share
one pass. A group rule compares rows with each other or with another table and has a
plan of its own. Unless a rule is about NULLs, a NULL value does not fail.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.neighbours import find_hot_groups, group_rows, with_neighbour

Params = Mapping[str, Any]
Tables = Callable[[str], DataFrame]

COMPARISONS = ("=", "!=", "<>", "<", "<=", ">", ">=")


def _name(column: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in column.split("."))


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _outside(value: str, low: Any, high: Any) -> str:
    if low is None and high is None:
        raise ValueError("give a lower or an upper bound")
    tests = [] if low is None else [f"{value} < {_literal(low)}"]
    tests += [] if high is None else [f"{value} > {_literal(high)}"]
    return " OR ".join(tests)


def _operator(params: Params) -> str:
    operator = str(params["operator"]).strip()
    if operator not in COMPARISONS:
        raise ValueError(f"unknown comparison {operator!r}")
    return operator


def key_list(value: Any) -> list[str]:
    """Key columns from a list, or from text such as ``['a', 'b']`` or ``a, b``."""
    if value is None:
        return []
    if isinstance(value, str):
        value = value.translate(str.maketrans("", "", "'[]")).split(",")
    return [str(part).strip() for part in value if str(part).strip()]


# ---------------------------------------------------------------- row rules


def attribute_length(p: Params) -> str:
    return _outside(f"length({_name(p['column_name'])})", p.get("min_length"), p.get("max_length"))


def attribute_range(p: Params) -> str:
    return _outside(_name(p["column_name"]), p.get("min_value"), p.get("max_value"))


def column_compare(p: Params) -> str:
    return f"NOT ({_name(p['column_name'])} {_operator(p)} {_name(p['compare_column'])})"


def conditional_null(p: Params) -> str:
    return f"({p['condition']}) AND {_name(p['column_name'])} IS NULL"


def date_consistency(p: Params) -> str:
    return f"{_name(p['start_column'])} > {_name(p['end_column'])}"


def not_null(p: Params) -> str:
    """NULL fails; with ``empty_is_null`` so does text that is empty."""
    name = _name(p["column_name"])
    if p.get("empty_is_null") in (True, "true", "Y"):
        return f"{name} IS NULL OR CAST({name} AS STRING) = ''"
    return f"{name} IS NULL"


def id_and_description(p: Params) -> str:
    return f"({_name(p['id_column'])} IS NULL) <> ({_name(p['desc_column'])} IS NULL)"


def regex(p: Params) -> str:
    return f"NOT ({_name(p['column_name'])} RLIKE {_literal(p['pattern'])})"


def unexpected_values(p: Params) -> str:
    allowed = ", ".join(_literal(v) for v in p["allowed_values"] if v is not None)
    if not allowed:
        return f"{_name(p['column_name'])} IS NOT NULL"
    return f"{_name(p['column_name'])} NOT IN ({allowed})"


def value_compare(p: Params) -> str:
    return f"NOT ({_name(p['column_name'])} {_operator(p)} {_literal(p['value'])})"


# -------------------------------------------------------------- group rules
# Each gives one row (total, failed) for the rows that ``counted`` selects.


def unique(table: DataFrame, counted: Column, p: Params, tables: Tables) -> DataFrame:
    """Rows whose key occurs more than once in the table."""
    return repeated(table, counted, unique_keys(p), [EVERY]).toDF("total", "failed")


def unique_active(table: DataFrame, counted: Column, p: Params, tables: Tables) -> DataFrame:
    """Active rows whose key occurs more than once among active rows."""
    return repeated(table, counted, unique_keys(p), [ACTIVE]).toDF("total", "failed")


# Rows that a uniqueness rule looks at, as SQL.
EVERY = "true"
ACTIVE = "coalesce(active_flg = 'Y', false)"


def unique_keys(p: Params) -> list[str]:
    return key_list(p.get("key_column") or p["column_name"])


def repeated(
    table: DataFrame, counted: Column, keys: list[str], considered: list[str]
) -> DataFrame:
    """One row: the number of counted rows, and for each of ``considered`` the failing ones.
    All rules on one key share the shuffle."""
    # Counted map-side: a key with a third of all rows moves as one row per task.
    sides = [F.expr(c) for c in considered]
    groups = table.groupBy(*keys).agg(
        F.count_if(counted).alias("all_rows"),
        *[F.count_if(side).alias(f"copies{i}") for i, side in enumerate(sides)],
        *[F.count_if(side & counted).alias(f"rows{i}") for i, side in enumerate(sides)],
    )
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    failed = [
        F.when(complete & (F.col(f"copies{i}") > 1), F.col(f"rows{i}")).otherwise(0)
        for i in range(len(sides))
    ]
    return groups.agg(
        _total("all_rows").alias("total"),
        *[_total(f).alias(f"f{i}") for i, f in enumerate(failed)],
    )


def referential_integrity(
    table: DataFrame, counted: Column, p: Params, tables: Tables
) -> DataFrame:
    """Rows whose key is missing in the referenced table."""
    keys = key_list(p.get("key_column") or p["column_name"])
    parent_keys = key_list(p["ref_column"])
    # Keys are folded on both sides first, so the join sees each of them once.
    children = table.groupBy(*keys).agg(F.count_if(counted).alias("rows"))
    parents = (
        tables(p["ref_table"])
        .select(*[F.col(r).alias(k) for k, r in zip(keys, parent_keys, strict=True)])
        .distinct()
        .withColumn("__known", F.lit(True))
    )
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    orphan = complete & F.col("__known").isNull()
    joined = children.join(parents, keys, "left")
    return joined.agg(
        _total("rows"), _total(F.when(orphan, F.col("rows")).otherwise(0))
    ).toDF("total", "failed")


def unchanged_version(
    table: DataFrame, counted: Column, p: Params, tables: Tables
) -> DataFrame:
    """Versions that carry the same attribute value as the version before them."""
    keys = key_list(p["key_column"])
    order = key_list(p.get("order_column") or "start_ts")
    rows = table.select(
        *keys,
        *[c for c in order if c not in keys],
        F.struct(F.col(p["column_name"]).alias("v")).alias("__value"),
        counted.alias("__counted"),
    )
    # Ties in the order are broken by the value, so that the count does not depend on the run.
    rows = rows.withColumn("__text", F.to_json("__value"))
    hot = find_hot_groups(rows.select(*keys), keys, group_rows(rows))
    rows = with_neighbour(
        rows, keys, [*order, "__text"], {"__before": "__value"}, back=True, hot=hot
    )
    same = F.col("__before").isNotNull() & F.col("__before").eqNullSafe(F.col("__value"))
    return rows.agg(
        F.count_if("__counted").alias("total"),
        F.count_if(F.col("__counted") & same).alias("failed"),
    )


def _total(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


# ---------------------------------------------------- failing rows of group rules
# Each gives a query for the rows that the rule counts as failed; ``where`` selects the batch.


def _known(keys: list[str], side: str = "") -> str:
    return " AND ".join(f"{side}{_name(k)} IS NOT NULL" for k in keys)


def _repeated_rows(considered: str) -> Callable[[str, Params, str], str]:
    def query(name: str, p: Params, where: str) -> str:
        keys = unique_keys(p)
        names = ", ".join(_name(k) for k in keys)
        same = " AND ".join(f"t.{_name(k)} = d.{_name(k)}" for k in keys)
        return (
            f"SELECT t.* FROM {name} t LEFT SEMI JOIN (SELECT {names} FROM {name} WHERE {considered} "
            f"AND {_known(keys)} GROUP BY {names} HAVING count(*) > 1) d ON {same} "
            f"WHERE {where}{considered}"
        )

    return query


def _orphans(name: str, p: Params, where: str) -> str:
    keys, parents = key_list(p.get("key_column") or p["column_name"]), key_list(p["ref_column"])
    same = " AND ".join(f"t.{_name(k)} = r.{_name(r)}" for k, r in zip(keys, parents, strict=True))
    return f"SELECT t.* FROM {name} t LEFT ANTI JOIN {p['ref_table']} r ON {same} WHERE {where}{_known(keys, 't.')}"


def _unchanged(name: str, p: Params, where: str) -> str:
    keys, column = key_list(p["key_column"]), _name(p["column_name"])
    order = key_list(p.get("order_column") or "start_ts")
    value = f"struct({column} AS v)"
    by, along = ", ".join(map(_name, keys)), ", ".join([*map(_name, order), f"to_json({value})"])
    before = f"lag({value}) OVER (PARTITION BY {by} ORDER BY {along})"
    return (
        f"SELECT * EXCEPT (__before) FROM (SELECT *, {before} AS __before FROM {name}) "
        f"WHERE {where}__before IS NOT NULL AND __before.v <=> {column}"
    )


# The names by which configurations ask for a rule.
ROW_RULES: dict[str, Callable[[Params], str]] = {
    "dq_rule_attribute_length_check": attribute_length,
    "dq_rule_attribute_within_range_check": attribute_range,
    "dq_rule_column_value_compare": column_compare,
    "dq_rule_conditional_null": conditional_null,
    "dq_rule_date_consistency": date_consistency,
    "dq_rule_not_null": not_null,
    "dq_rule_not_null_id_vs_desc": id_and_description,
    "dq_rule_regex_check": regex,
    "dq_rule_unexpected_values": unexpected_values,
    "dq_rule_value_comparision_check": value_compare,
}
GROUP_RULES: dict[str, Callable[[DataFrame, Column, Params, Tables], DataFrame]] = {
    "dq_rule_referential_integrity": referential_integrity,
    "dq_rule_scd2_change_in_attribute_value": unchanged_version,
    "dq_rule_unique": unique,
    "dq_rule_unique_typ2": unique_active,
}

UNIQUE_RULES: dict[str, str] = {"dq_rule_unique": EVERY, "dq_rule_unique_typ2": ACTIVE}
GROUP_QUERIES: dict[str, Callable[[str, Params, str], str]] = {
    "dq_rule_referential_integrity": _orphans,
    "dq_rule_scd2_change_in_attribute_value": _unchanged,
    "dq_rule_unique": _repeated_rows(EVERY),
    "dq_rule_unique_typ2": _repeated_rows(ACTIVE),
}

__all__ = ["GROUP_QUERIES", "GROUP_RULES", "ROW_RULES", "UNIQUE_RULES", "key_list"]
