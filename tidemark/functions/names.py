"""Table-name and key-list text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def table_for_view(name: Column | str) -> Column:
    """The table behind a view name: a final ``_v`` or ``_V`` becomes ``_t``."""
    return F.regexp_replace(_col(name), "_[vV]$", "_t")


def name_parts(name: Column | str) -> Column:
    """Struct (db, schema, table) of a three-part name; quotes are dropped."""
    parts = F.split(F.replace(_col(name), F.lit('"'), F.lit("")), r"\.")
    return F.struct(
        F.get(parts, F.lit(0)).alias("db"),
        F.get(parts, F.lit(1)).alias("schema"),
        F.get(parts, F.lit(2)).alias("table"),
    )


def delete_table_name(name: Column | str) -> Column:
    """Name of the table that lists deletes for ``name``: two-letter suffix -> ``_del_t``."""
    name = _col(name)
    return F.concat(F.substring(name, F.lit(1), F.length(name) - 2), F.lit("_del_t"))


def strip_key_list(text: Column | str) -> Column:
    """A key list such as ``['a', 'b']`` without quotes and brackets."""
    return F.translate(_col(text), "'[]", "")
