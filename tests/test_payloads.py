from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import batch_id_from, blank_to_null, delete_table_name, hash_key, iso_text
from tidemark.functions import failure_ratio, name_parts, result_status, strip_key_list, table_for_view
from tidemark.functions.in_sql import SCALARS, register_functions
from tidemark.operators.payload_drift import known_after, payload_drift, payload_fields
from tidemark.operators.quality.config import EXPECTATION, PROJECT, config_elements, upsert_readable
from tidemark.operators.quality.in_sql import register_rule
from tidemark.sources import schemas
from tidemark.sources.tables import empty

NOW = "2024-02-01 00:00:00"


def test_elements_of_any_shape(frame):
    payloads = ['[{"project_id":"1","project_name":{"a":1},"owner":2.50,"more":1}, 7, null, {"owner":"z"}]',
                '[{"project_id"', '{"project_id":"9"}', None, "[]", "null", '[{"project_id":5,"active_flg":true}]', ""]
    got = config_elements(frame([(p,) for p in payloads], "payload string"), PROJECT)
    assert rows_of(got.filter("reason IS NULL"), "project_id", "project_name", "owner", "active_flg", "pos") == [
        ("1", '{"a":1}', "2.5", None, 0), ("5", None, None, "true", 0)
    ]
    assert rows_of(got.filter("reason IS NOT NULL"), "reason", "pos", "element") == sorted([
        ("no key", 3, '{"owner":"z"}'), ("not an array", None, "null"), ("not an array", None, '{"project_id":"9"}'),
        ("not an object", 1, "7"), ("not an object", 2, "null"), ("not json", None, ""), ("not json", None, '[{"project_id"'),
    ], key=repr)


def test_a_broken_payload_holds_up_no_other(spark, frame):
    payloads = frame([("broken",), ('[{"exp_id":"1","group_id":"g","param_value":{"table_name":"t"}}]',)], "payload string")
    new, rejects = upsert_readable(empty(spark, schemas.DQ_EXPECTATION), payloads, EXPECTATION, NOW)
    assert rows_of(new, "exp_id", "group_id", "param_value") == [("1", "g", '{"table_name":"t"}')]
    assert rows_of(rejects) == [("not json", None, "broken")]
    none, rejects = upsert_readable(new, payloads.limit(0), EXPECTATION, NOW)
    assert none.count() == 1 and rejects.count() == 0


def payloads(frame, *rows):
    return payload_fields(frame(list(rows), "model_id string, j string").select("model_id", F.try_parse_json("j").alias("raw_json")))


def test_fields_of_payloads(frame):
    got = payloads(frame, ("m", '{"a":1,"b":"x","c":null,"d":{"e":1.5}}'), ("m", '{"a":2.5,"b":3}'),
                   ("n", "[1]"), ("n", None), ("n", '{"a":null}'), ("n", "{"))
    assert rows_of(got, "model_id", "column_name", "data_type") == [
        ("m", "a", "number"), ("m", "b", "variant"), ("m", "c", "void"), ("m", "d", "object<e: number>"), ("n", "a", "void")
    ]


def test_a_field_that_was_only_null_is_of_no_other_type(frame):
    known = payloads(frame, ("m", '{"a":1,"b":null,"c":[1],"d":"x"}'))
    batch = payloads(frame, ("m", '{"a":null,"b":"x","c":["x"],"e":1}'))
    assert rows_of(payload_drift(batch, known), "column_name", "diff_type") == [
        ("c", "TYPE_MISMATCH"), ("d", "MISSING_IN_SOURCE"), ("e", "MISSING_IN_TARGET")
    ]
    after = known_after(batch, known)
    assert rows_of(after, "column_name", "data_type") == [
        ("a", "number"), ("b", "string"), ("c", "array<string>"), ("d", "string"), ("e", "number")
    ]
    assert rows_of(payload_drift(batch, after), "column_name") == [("d",)]


def test_functions_in_sql_give_what_the_column_functions_give(spark, frame):
    names = register_functions(spark, "t_")
    assert len(names) == len(SCALARS)
    rows = [(" ab ", "", 1, 4, datetime(2024, 2, 3, 4, 5, 6, 7000)), (None, None, 0, 0, None), ("", " ", 3, 3, datetime(2024, 1, 1)),
            ('"db".s.pay_V', "['a', 'b']", None, 2, datetime(1999, 12, 31, 23, 59, 59))]
    df = frame(rows, "a string, b string, failed long, total long, ts timestamp_ntz")
    pairs = {
        "t_blank_to_null(a)": blank_to_null("a"),
        "t_hash_key(array(a))": hash_key(["a"]),
        "t_hash_key(array(a, b))": hash_key(["a", "b"]),
        "t_hash_key(array(a, string(failed), string(CAST(ts AS DATE))))": hash_key(["a", "failed", F.col("ts").cast("date")]),
        "t_batch_id_from(ts)": batch_id_from(F.col("ts")),
        "t_iso_text(ts)": iso_text(F.col("ts")),
        "t_table_for_view(a)": table_for_view("a"),
        "t_name_parts(a)": name_parts("a"),
        "t_delete_table_name(a)": delete_table_name("a"),
        "t_strip_key_list(b)": strip_key_list("b"),
        "t_failure_ratio(failed, total)": failure_ratio(F.col("failed"), F.col("total")),
        "t_result_status(failed)": result_status(F.col("failed")),
    }
    got = df.select(*[F.expr(sql).alias(f"s{i}") for i, sql in enumerate(pairs)]).collect()
    want = df.select(*[column.alias(f"s{i}") for i, column in enumerate(pairs.values())]).collect()
    assert got == want


def test_a_condition_on_failing_rows_reaches_the_scan(spark, folder):
    spark.read.parquet(f"{folder}/orders.parquet").createOrReplaceTempView("some_orders")
    register_rule(spark, "late_ones", "dq_rule_regex_check", {"table_name": "some_orders", "column_name": "o_orderpriority", "pattern": "^[1-3]"})
    plan = spark.sql("SELECT o_orderkey FROM late_ones() WHERE o_custkey = 7")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,7)" in shown and "o_totalprice" not in shown and "Python" not in shown
    with pytest.raises(ValueError):
        register_rule(spark, "none", "dq_rule_no_such_rule", {"table_name": "some_orders"})
    with pytest.raises(Exception, match="no_such"):
        register_rule(spark, "none", "dq_rule_not_null", {"table_name": "some_orders", "column_name": "no_such"})
