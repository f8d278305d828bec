from tidemark.operators.quality.config import (
    active_expectations,
    config_rows,
    upsert_expectations,
    upsert_groups,
    upsert_projects,
    upsert_rules,
)
from tidemark.operators.quality.rules import GROUP_RULES, ROW_RULES
from tidemark.operators.quality.run import RESULT_KEYS, Check, run_checks, run_quality

__all__ = [
    "Check",
    "GROUP_RULES",
    "RESULT_KEYS",
    "ROW_RULES",
    "active_expectations",
    "config_rows",
    "run_checks",
    "run_quality",
    "upsert_expectations",
    "upsert_groups",
    "upsert_projects",
    "upsert_rules",
]
