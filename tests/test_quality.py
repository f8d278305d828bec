import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import neighbours
from tidemark.operators.quality import (
    GROUP_RULES,
    ROW_RULES,
    Check,
    active_expectations,
    config_rows,
    run_checks,
    run_quality,
    upsert_expectations,
    upsert_groups,
    upsert_projects,
    upsert_rules,
)
from tidemark.operators.quality.config import PROJECT
from tidemark.operators.quality.rules import key_list
from tidemark.sources import schemas
from tidemark.sources.tables import empty

NOW = "2024-02-01 00:00:00"


@pytest.fixture
def payload(spark):
    return lambda *objects: spark.range(1).select(F.lit(json.dumps(list(objects))).alias("payload"))


def counts(checks, tables, batch_id=None):
    got = run_checks(checks, tables, batch_id)
    return {r["exp_id"]: (r["total_record_count"], r["failure_record_count"]) for r in got.collect()}


@pytest.fixture
def data(frame):
    return frame(
        [(1, "a", "x", 1.0, 2.0, "Y", 1), (2, None, "y", 5.0, 1.0, "Y", 1), (2, "", None, None, 3.0, "N", 1),
         (3, "it's", None, 9.0, 9.0, "Y", 2), (None, None, None, -1.0, None, "Y", None)],
        "id int, name string, descr string, low double, high double, active_flg string, batch_id int",
    )


ROW_CASES = [
    ("dq_rule_not_null", {"column_name": "name"}, 2),
    ("dq_rule_not_null_id_vs_desc", {"id_column": "name", "desc_column": "descr"}, 3),
    ("dq_rule_attribute_length_check", {"column_name": "name", "min_length": 1, "max_length": 3}, 2),
    ("dq_rule_attribute_within_range_check", {"column_name": "low", "min_value": 0}, 1),
    ("dq_rule_attribute_within_range_check", {"column_name": "low", "min_value": 0, "max_value": 4.5}, 3),
    ("dq_rule_column_value_compare", {"column_name": "low", "operator": "<", "compare_column": "high"}, 2),
    ("dq_rule_conditional_null", {"column_name": "descr", "condition": "name IS NOT NULL"}, 2),
    ("dq_rule_date_consistency", {"start_column": "low", "end_column": "high"}, 1),
    ("dq_rule_regex_check", {"column_name": "name", "pattern": "^\\w+$"}, 2),
    ("dq_rule_unexpected_values", {"column_name": "name", "allowed_values": ["a", "it's"]}, 1),
    ("dq_rule_unexpected_values", {"column_name": "name", "allowed_values": []}, 3),
    ("dq_rule_value_comparision_check", {"column_name": "id", "operator": ">=", "value": 2}, 1),
    ("dq_rule_value_comparision_check", {"column_name": "name", "operator": "!=", "value": "it's"}, 1),
]


def test_row_rules(data):
    checks = [Check(str(i), rule, {"table_name": "t", **p}) for i, (rule, p, _) in enumerate(ROW_CASES)]
    assert counts(checks, {"t": data}) == {str(i): (5, want) for i, (_, _, want) in enumerate(ROW_CASES)}
    assert {rule for rule, _, _ in ROW_CASES} == set(ROW_RULES)


def test_failure_query_finds_the_failing_rows(spark, data):
    data.createOrReplaceTempView("dq_data")
    for rule, params, want in ROW_CASES:
        got = run_checks([Check("e", rule, {"table_name": "dq_data", **params})], {"dq_data": data}).first()
        assert spark.sql(got["failure_record_query"]).count() == want
    one = run_checks([Check("e", "dq_rule_not_null", {"table_name": "dq_data", "column_name": "name"})], {"dq_data": data}, 1)
    assert spark.sql(one.first()["failure_record_query"]).count() == 1


def test_row_rules_share_one_scan(data, spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    params = {"table_name": "o", "column_name": "o_orderstatus"}
    checks = [Check(str(i), "dq_rule_not_null", params) for i in range(40)]
    plan = run_checks(checks, {"o": orders})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_batch_slice(data):
    check = Check("e", "dq_rule_not_null", {"table_name": "t", "column_name": "name"})
    assert counts([check], {"t": data}, 1) == {"e": (3, 1)}
    assert counts([check], {"t": data}, 9) == {"e": (0, 0)}


def test_unique_counts_rows_of_repeated_keys(data):
    def check(rule, **params):
        return Check(rule, f"dq_rule_{rule}", {"table_name": "t", **params})

    assert counts([check("unique", key_column="id")], {"t": data}) == {"unique": (5, 2)}
    assert counts([check("unique", column_name="name")], {"t": data}) == {"unique": (5, 0)}
    assert counts([check("unique_typ2", key_column=["id"])], {"t": data}) == {"unique_typ2": (5, 0)}
    # A repeat in another batch fails the rows of this one.
    late = data.withColumn("batch_id", F.when(F.col("active_flg") == "Y", 1).otherwise(2))
    assert counts([check("unique", key_column="id")], {"t": late}, 2) == {"unique": (1, 1)}


def test_referential_integrity(data, frame):
    parents = frame([(1,), (1,), (None,)], "ref int")
    params = {"table_name": "t", "column_name": "id", "ref_table": "p", "ref_column": "ref"}
    check = Check("e", "dq_rule_referential_integrity", params)
    assert counts([check], {"t": data, "p": parents}) == {"e": (5, 3)}
    assert counts([check], {"t": data, "p": parents}, 2) == {"e": (1, 1)}


@pytest.mark.parametrize("hot", [False, True])
def test_unchanged_versions(frame, monkeypatch, hot):
    if hot:
        from tidemark.operators.quality import rules

        monkeypatch.setattr(
            rules, "find_hot_groups",
            lambda df, g, n: neighbours.find_hot_groups(df, g, 1),
        )
    history = frame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, None), ("a", 5, None), ("b", 1, "y"), ("b", 2, "x")],
        "k string, start_ts int, v string",
    )
    check = Check("e", "dq_rule_scd2_change_in_attribute_value", {"table_name": "t", "key_column": "k", "column_name": "v"})
    assert counts([check], {"t": history}) == {"e": (7, 2)}


def test_a_wrong_check_gets_an_error_and_the_others_run(data):
    good = Check("good", "dq_rule_not_null", {"table_name": "t", "column_name": "name"})
    bad = [
        Check("table", "dq_rule_not_null", {"table_name": "nowhere", "column_name": "name"}),
        Check("column", "dq_rule_not_null", {"table_name": "t", "column_name": "missing"}),
        Check("key", "dq_rule_unique", {"table_name": "t", "key_column": "missing"}),
        Check("params", "dq_rule_attribute_within_range_check", {}),
        Check("parent", "dq_rule_referential_integrity", {"table_name": "t", "column_name": "id", "ref_table": "p", "ref_column": "x"}),
    ]
    got = {r["exp_id"]: r for r in run_checks([good, *bad], {"t": data}).collect()}
    assert got["good"]["total_record_count"] == 5 and len(got) == 6
    for check in bad:
        row = got[check.exp_id]
        assert row["total_record_count"] is None and row["failure_record_query"].startswith("-- ")


def test_ids_must_differ(data):
    check = Check("e", "dq_rule_not_null", {"table_name": "t", "column_name": "name"})
    with pytest.raises(ValueError, match="'e'"):
        run_checks([check, check], {"t": data})


def test_uniqueness_of_one_key_shares_a_shuffle(data):
    checks = [
        Check("a", "dq_rule_unique", {"table_name": "t", "key_column": "id"}),
        Check("b", "dq_rule_unique_typ2", {"table_name": "t", "key_column": ["id"]}),
    ]
    plan = run_checks(checks, {"t": data})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_registered_names():
    assert len(ROW_RULES) + len(GROUP_RULES) == 14


def test_bad_parameters():
    with pytest.raises(ValueError):
        ROW_RULES["dq_rule_value_comparision_check"]({"column_name": "a", "operator": "; drop", "value": 1})
    with pytest.raises(ValueError):
        ROW_RULES["dq_rule_attribute_within_range_check"]({"column_name": "a"})
    assert key_list("['a', 'b']") == key_list("a,b") == key_list(["a", "b"]) == ["a", "b"]


def test_config_payloads(spark, payload):
    rows = config_rows(payload({"project_id": 1, "project_name": "it's \"x\"", "more": [1]}, {"project_id": "2"}), PROJECT)
    assert rows_of(rows) == [("1", "it's \"x\"", None, None), ("2", None, None, None)]
    broken = spark.range(1).select(F.lit("[{").alias("payload"))
    with pytest.raises(Exception, match="MALFORMED|PARSE|malformed"):
        config_rows(broken, PROJECT).collect()


def test_expectations_keep_their_group(spark, payload):
    first = upsert_expectations(
        empty(spark, schemas.DQ_EXPECTATION), payload({"exp_id": "e", "group_id": "g1", "col_name": "a"}), NOW
    )
    later = upsert_expectations(first, payload({"exp_id": "e", "group_id": "g2", "col_name": "b"}), "2024-03-01")
    got = later.first()
    assert (got["group_id"], got["col_name"]) == ("g1", "b")
    assert (got["created_ts"].month, got["modified_ts"].month) == (2, 3)


def test_duplicate_config_ids(spark, payload):
    twice = payload({"group_id": "g", "group_name": "a"}, {"group_id": "g", "group_name": "b"})
    with pytest.raises(Exception, match="duplicate key"):
        upsert_groups(empty(spark, schemas.DQ_GROUP), twice, NOW).collect()
    got = upsert_groups(empty(spark, schemas.DQ_GROUP), twice, NOW, duplicates="latest")
    assert rows_of(got, "group_name") == [("b",)]


def configured(spark, payload, *expectations):
    rules = [{"rule_id": e["exp_id"], "rule_name": "r", "rule_type": "t", "dbt_test": e.pop("dbt_test")} for e in expectations]
    return active_expectations(
        upsert_expectations(empty(spark, schemas.DQ_EXPECTATION), payload(*expectations), NOW),
        upsert_rules(empty(spark, schemas.DQ_RULE), payload(*rules), NOW),
        upsert_groups(empty(spark, schemas.DQ_GROUP), payload({"group_id": "g", "project_id": "p"}), NOW),
        upsert_projects(empty(spark, schemas.DQ_PROJECT), payload({"project_id": "p", "project_name": "n"}), NOW),
        "n",
    )


def expectation(name, test, flag="Y", **params):
    return {"exp_id": name, "group_id": "g", "active_flg": flag, "dbt_test": test, "param_value": json.dumps({"table_name": "t", **params})}


def test_run_skips_unknown_and_inactive(spark, data, payload):
    expectations = configured(
        spark, payload,
        expectation("e1", "dq_rule_not_null", column_name="name", key_column=["id"]),
        expectation("e2", "dq_rule_nothing"),
        expectation("e3", "dq_rule_not_null", flag="N", column_name="name"),
    )
    got = run_quality(expectations, {"t": data}, 1, NOW)
    assert got.columns == [f.split(" ")[0] for f in schemas.DQ_RESULT.replace("(38,0)", "").split(", ")]
    (only,) = got.collect()
    assert (only["exp_id"], only["result_status"], only["key_column"]) == ("e1", "Fail", "id")
    assert only["failure_ratio"] == pytest.approx(100 / 3) and only["batch_id"] == Decimal(1)
    assert only["rule_execution_ts"] == "2024-02-01T00:00:00"


def test_run_of_nothing(spark, data, payload):
    expectations = configured(spark, payload, expectation("e2", "dq_rule_nothing"))
    assert run_quality(expectations, {"t": data}, 1, NOW).count() == 0


def test_run_on_an_empty_batch_succeeds(spark, data, payload):
    expectations = configured(spark, payload, expectation("e1", "dq_rule_not_null", column_name="name"))
    (only,) = run_quality(expectations, {"t": data}, 99, NOW).collect()
    assert (only["total_record_count"], only["failure_ratio"], only["result_status"]) == (0, 0.0, "Success")
