"""Options of operators that change what counts."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators.deletes import capture_deletes
from tidemark.operators.quality import Check, run_checks
from tidemark.plans.gold import summary_rows
from tidemark.sources import schemas
from tidemark.sources.tables import empty


def payments(frame):
    rows = [("p1", "a", "10", "x", 1), ("p2", "a", "5", "b", 2), ("p3", "b", "1", "c", 1)]
    return frame(rows, "payment_id string, application_id string, amount string, payment_status string, day int").select(
        "payment_id", "application_id", "payment_status", F.col("amount").cast("decimal(18,2)").alias("payment_amount"),
        F.lit("2024-01-01").cast("date").alias("payment_date"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("day"))).alias("src_load_ts"),
    )


def test_lifetime_totals_and_newest_status(spark, frame):
    applications = empty(spark, schemas.APPLICATION)
    run = {"batch_id": "1", "now": "2024-02-01", "watermark": "2024-01-02 12:00:00"}

    def totals(**options):
        rows = summary_rows(payments(frame), applications, **run, **options)
        return [(r[0], int(r[1]), r[2]) for r in rows.select("application_id", "total_payments", "last_status").collect()]

    assert totals() == [("a", 5, "b")]
    assert totals(lifetime=True) == [("a", 15, "x")]
    assert totals(lifetime=True, newest_status=True) == [("a", 15, "b")]


def test_a_key_that_came_back_is_not_deleted(spark, frame):
    changes = frame(
        [("1", 1, "IncrementalDeleteRows"), ("1", 2, "insert"), ("2", 1, "insert"), ("2", 2, "IncrementalDeleteRows")],
        "primary_key__pk string, day int, event_type string",
    ).select(
        "primary_key__pk", "event_type", F.lit(0).alias("least_significant_position"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("day"), F.lit(0), F.lit(0), F.lit(0)).alias("seen_at"),
    )
    log = empty(
        spark,
        "model_id string, model_grp string, pipeline_name string, pk string, src_load_ts timestamp_ntz, "
        "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
    )
    named = {"model_id": F.lit("m"), "model_grp": F.lit("g"), "pipeline_name": F.lit("p")}
    run = {"batch_id": "1", "now": datetime(2024, 2, 1)}
    assert rows_of(capture_deletes(changes, log, **named, **run), "pk") == [("1",), ("2",)]
    assert rows_of(capture_deletes(changes, log, **named, **run, latest_event=True), "pk") == [("2",)]


def test_empty_text_counts_as_missing_when_asked(frame):
    data = frame([("",), (None,), ("x",)], "name string")
    params = {"table_name": "t", "column_name": "name"}
    checks = [Check("null", "dq_rule_not_null", params), Check("both", "dq_rule_not_null", params | {"empty_is_null": True})]
    got = run_checks(checks, {"t": data}).select("exp_id", "failure_record_count")
    assert rows_of(got) == [("both", 2), ("null", 1)]
