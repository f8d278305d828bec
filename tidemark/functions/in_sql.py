"""The column functions for SQL text: functions of the session that Spark inlines.

They are SQL functions, no UDFs: a call is replaced by its expression when the query is
analysed, so filters, pruning and code generation see through it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.keys import EMPTY_MARK, EMPTY_PAIR, SEPARATOR
from tidemark.functions.times import BATCH_TYPE

# Signature and body of each; they give what the Column functions of the same names give.
SCALARS = {
    "blank_to_null(value STRING) RETURNS STRING": "nullif(value, '')",
    # The columns as text: array(a, string(n)), as an array of mixed types is not one of texts.
    "hash_key(parts ARRAY<STRING>) RETURNS STRING": f"""
        sha2(nullif(array_join(
            transform(parts, p -> coalesce(nullif(upper(trim(p)), ''), '{EMPTY_MARK}')), '{SEPARATOR}'),
            '{EMPTY_PAIR}'), 256)""",
    "batch_id_from(ts TIMESTAMP_NTZ) RETURNS DECIMAL(38,0)": f"""
        CAST(date_format(ts, 'yyyyMMddHHmmssSSSSSSSSS') AS {BATCH_TYPE})""",
    "iso_text(ts TIMESTAMP_NTZ) RETURNS STRING": "replace(CAST(ts AS STRING), ' ', 'T')",
    "table_for_view(name STRING) RETURNS STRING": "regexp_replace(name, '_[vV]$', '_t')",
    "name_parts(name STRING) RETURNS STRUCT<db: STRING, schema: STRING, table: STRING>": """
        named_struct(
            'db', get(split(replace(name, '"', ''), '[.]'), 0),
            'schema', get(split(replace(name, '"', ''), '[.]'), 1),
            'table', get(split(replace(name, '"', ''), '[.]'), 2))""",
    "delete_table_name(name STRING) RETURNS STRING": "concat(substring(name, 1, length(name) - 2), '_del_t')",
    "strip_key_list(value STRING) RETURNS STRING": """translate(value, "'[]", '')""",
    "failure_ratio(failed BIGINT, total BIGINT) RETURNS DOUBLE": """
        CASE WHEN total > 0 THEN CAST(failed AS DOUBLE) / CAST(total AS DOUBLE) * 100.0D ELSE 0.0D END""",
    "result_status(failed BIGINT) RETURNS STRING": "CASE WHEN failed > 0 THEN 'Fail' ELSE 'Success' END",
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions known to the session, as ``prefix`` and their names; the names."""
    names = []
    for signature, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURN {body}")
        names.append(prefix + signature.split("(")[0])
    return names
