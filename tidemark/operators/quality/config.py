"""Data-quality configuration: JSON arrays merged into four tables, and their join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import moment
from tidemark.operators.merge import merge
from tidemark.sources.tables import settle


@dataclass(frozen=True)
class ConfigKind:
    """A config table: its key, its other fields, and fields that never change again."""

    key: str
    fields: tuple[str, ...]
    fixed: tuple[str, ...] = ()


# The fields of the four kinds of config objects.
PROJECT = ConfigKind("project_id", ("project_name", "owner", "active_flg"))
GROUP = ConfigKind("group_id", ("group_name", "project_id"))
RULE = ConfigKind(
    "rule_id",
    (
        "rule_name",
        "rule_description",
        "rule_type",
        "dbt_test",
        "param_attrib",
        "expected_value",
    ),
)
EXPECTATION = ConfigKind(
    "exp_id",
    (
        "group_id",
        "exp_type",
        "exp_message",
        "exp_dt",
        "severity_level",
        "source_system",
        "escalation_poc",
        "active_flg",
        "schema_name",
        "tbl_name",
        "full_tbl_name",
        "col_name",
        "param_value",
    ),
    fixed=("group_id",),
)


def config_rows(payloads: DataFrame, kind: ConfigKind, column: str = "payload") -> DataFrame:
    """One row per element of the JSON arrays; broken JSON fails the job."""
    fields = ", ".join(f"{name}: string" for name in (kind.key, *kind.fields))
    elements = F.from_json(column, f"array<struct<{fields}>>", {"mode": "FAILFAST"})
    return payloads.select(F.inline(elements))


# Why an element or a payload was left out.
NOT_JSON, NOT_AN_ARRAY, NOT_AN_OBJECT, NO_KEY = "not json", "not an array", "not an object", "no key"


def config_elements(payloads: DataFrame, kind: ConfigKind, column: str = "payload") -> DataFrame:
    """One row per element of the JSON arrays, whatever its shape, and one per payload that has
    no elements to read: the fields as text, ``element`` (JSON; the payload itself where it is
    broken), ``pos`` in its payload, and ``reason``, NULL for an element that can be merged.

    A field may be of any type: an object or an array is read as its JSON, a number as it is
    written without needless digits. Fields of other names are ignored. A NULL payload and an
    empty array have no rows.
    """
    parsed = payloads.select(F.col(column).alias("__text")).filter("__text IS NOT NULL")
    parsed = parsed.withColumn("__json", F.try_parse_json("__text"))
    is_array = F.coalesce(F.schema_of_variant("__json").startswith("ARRAY"), F.lit(False))
    # A payload without elements to read stands as one, to be rejected.
    whole = F.when(is_array, F.col("__json")).otherwise(F.parse_json(F.lit("[null]")))
    parsed = parsed.withColumns({"__array": is_array, "__elements": whole})
    each = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("__elements").outer()))
    is_object = F.schema_of_variant("value").startswith("OBJECT")
    fields = {
        name: F.when(F.col("__array") & is_object, F.try_variant_get("value", f"$.{name}", "string"))
        for name in (kind.key, *kind.fields)
    }
    reason = (
        F.when(F.col("__json").isNull(), F.lit(NOT_JSON))
        .when(~F.col("__array"), F.lit(NOT_AN_ARRAY))
        .when(~is_object, F.lit(NOT_AN_OBJECT))
        .when(fields[kind.key].isNull(), F.lit(NO_KEY))
    )
    return each.select(
        *[value.alias(name) for name, value in fields.items()],
        F.when(F.col("__array"), F.to_json("value")).otherwise(F.col("__text")).alias("element"),
        F.when(F.col("__array"), F.col("pos")).alias("pos"),
        reason.alias("reason"),
    )


def upsert_readable(
    target: DataFrame, payloads: DataFrame, kind: ConfigKind, now, *, column: str = "payload", **options
) -> tuple[DataFrame, DataFrame]:
    """``upsert_config`` with the elements that can be merged, and the others as (reason, pos,
    element): a broken payload or element holds up no other. Payloads are read once."""
    elements = settle(config_elements(payloads, kind, column))
    good = elements.filter("reason IS NULL").select(kind.key, *kind.fields)
    rejects = elements.filter("reason IS NOT NULL").select("reason", "pos", "element")
    return _merged(target, good, kind, now, **options), rejects


def upsert_config(
    target: DataFrame,
    payloads: DataFrame,
    kind: ConfigKind,
    now,
    *,
    column: str = "payload",
    duplicates: str = "error",
) -> DataFrame:
    """Merge config objects by id; the creation time of a known id stays."""
    return _merged(target, config_rows(payloads, kind, column), kind, now, duplicates=duplicates)


def _merged(
    target: DataFrame, rows: DataFrame, kind: ConfigKind, now, *, duplicates: str = "error"
) -> DataFrame:
    rows = rows.withColumns({"created_ts": moment(now), "modified_ts": moment(now)})
    changing = [f for f in kind.fields if f not in kind.fixed] + ["modified_ts"]
    return merge(
        target,
        rows,
        kind.key,
        update=changing,
        empty_matches=True,
        duplicates=duplicates,
        order_by=[F.desc(f) for f in kind.fields] if duplicates == "latest" else (),
    )


def upsert_projects(target: DataFrame, payloads: DataFrame, now, **options) -> DataFrame:
    return upsert_config(target, payloads, PROJECT, now, **options)


def upsert_groups(target: DataFrame, payloads: DataFrame, now, **options) -> DataFrame:
    return upsert_config(target, payloads, GROUP, now, **options)


def upsert_rules(target: DataFrame, payloads: DataFrame, now, **options) -> DataFrame:
    return upsert_config(target, payloads, RULE, now, **options)


def upsert_expectations(target: DataFrame, payloads: DataFrame, now, **options) -> DataFrame:
    """Like the others, but an expectation never moves to another group."""
    return upsert_config(target, payloads, EXPECTATION, now, **options)


def active_expectations(
    expectations: DataFrame,
    rules: DataFrame,
    groups: DataFrame,
    projects: DataFrame,
    project_name: str | None = None,
) -> DataFrame:
    """Active expectations with their rule, group and project, of one project or of all.

    An expectation belongs to the rule with the same id.
    """
    projects = projects.select("project_id", "project_name")
    if project_name is not None:
        projects = projects.filter(F.col("project_name") == project_name)
    active = expectations.filter(F.col("active_flg") == "Y")
    named_rules = rules.select("rule_id", "rule_name", "rule_type", "dbt_test")
    return (
        active.join(named_rules, active["exp_id"] == named_rules["rule_id"])
        .join(groups.select("group_id", "group_name", "project_id"), "group_id")
        .join(projects, "project_id")
        .select(
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
            "param_value",
            "schema_name",
            "tbl_name",
            "full_tbl_name",
            "col_name",
            "exp_dt",
            "severity_level",
            "source_system",
            "escalation_poc",
            "active_flg",
        )
    )
