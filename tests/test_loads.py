"""Tables, whole batches, and raw files as a stream."""

import json
import os
from datetime import datetime, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions.keys import hash_key
from tidemark.operators import neighbours
from tidemark.operators.merge import merge
from tidemark.plans.batch import Layout, open_batch, run_batch
from tidemark.plans.load import load_silver, load_summary, publish_silver, publish_summary
from tidemark.plans import silver
from tidemark.plans.steps import delete_step, drift_step, quality_step
from tidemark.plans.totals import fold
from tidemark.sources import parted, schemas
from tidemark.sources.parted import PART, merge_into, parts_of, rows_in, rows_name
from tidemark.sources.tables import (
    StateChanged,
    append,
    current_version,
    drop,
    empty,
    exists,
    prune,
    publish,
    read,
    replace_partitions,
    settle,
    settled_for_now,
    shared_folder,
    update,
    versions,
)
from tidemark.sources.tables import state as state_of
from tidemark.streaming.increments import follow_raw, silver_increment
from workload.common import MARK, application_raw, payment_raw


def test_publish_switches_and_reads_itself(spark, frame):
    publish(frame([(1, "a")], "k int, v string"), "t_switch")
    before = read(spark, "t_switch")
    publish(read(spark, "t_switch").withColumn("v", F.lit("b")), "t_switch")
    assert rows_of(read(spark, "t_switch")) == [(1, "b")]
    assert rows_of(before) == [(1, "a")]


def test_old_versions_are_pruned(spark, frame):
    for n in range(4):
        publish(frame([(n,)], "n int"), "t_versions")
    assert len(versions(spark, "t_versions")) == 4
    prune(spark, "t_versions", keep=2)
    assert len(versions(spark, "t_versions")) == 2
    prune(spark, "t_versions", keep=0)
    assert versions(spark, "t_versions") == [current_version(spark, "t_versions")]
    assert rows_of(read(spark, "t_versions")) == [(3,)]
    with pytest.raises(ValueError):
        prune(spark, "t_versions", keep=-1)
    drop(spark, "t_versions")
    assert not exists(spark, "t_versions") and versions(spark, "t_versions") == []


def upsert(spark, name, rows, **options):
    """Newest row by key, through the partitions of the table."""
    change = lambda current: merge(current, rows, "k", duplicates="trust")
    return merge_into(spark, name, "k string, v int", ["k"], rows, change, **options)


def files(spark, name):
    """The files of each partition."""
    found = spark.table(rows_name(name)).select(PART, F.input_file_name().alias("f")).distinct().collect()
    return {(r[PART], r["f"]) for r in found}


def test_a_change_rewrites_the_partitions_it_names(spark, frame):
    ddl = "k string, v int"
    upsert(spark, "t_parted", frame([(str(i), 0) for i in range(200)], ddl), parts=16)
    before = files(spark, "t_parted")
    seen = upsert(spark, "t_parted", frame([("7", 1), ("new", 1)], ddl), measures={"ones": F.sum("v")})
    assert seen == {"ones": 2}
    touched = set(parts_of(frame([("7", 1), ("new", 1)], ddl).select("k"), ["k"], 16))
    after = files(spark, "t_parted")
    assert {p for p, _ in before ^ after} == touched and len(touched) <= 2
    want = sorted([(str(i), int(i == 7)) for i in range(200)] + [("new", 1)], key=repr)
    assert rows_of(read(spark, "t_parted")) == want
    # Of other partitions nothing is listed.
    scan = rows_in(spark, "t_parted", sorted(touched))
    assert all(int(f.split(f"{PART}=")[1].split("/")[0]) in touched for f in scan.inputFiles())
    drop(spark, "t_parted")
    assert not exists(spark, "t_parted")


def test_a_read_costs_the_same_after_ten_loads(spark, frame):
    def shape():
        plan = read(spark, "t_ten")._jdf.queryExecution().executedPlan().toString()
        return plan.count("Scan"), plan.count("Join"), plan.count("Union")

    for n in range(10):
        upsert(spark, "t_ten", frame([(str(i), n) for i in range(n, n + 3)], "k string, v int"), parts=4)
        assert shape() == (1, 0, 0)
    assert rows_of(read(spark, "t_ten")) == sorted(((str(i), min(i, 9)) for i in range(12)), key=repr)


def test_keyless_rows_stay_and_emptied_partitions_go(spark, frame):
    ddl = "k string, v int"
    upsert(spark, "t_null", frame([(None, 1), (None, 2), ("", 3), ("a", 4)], ddl), parts=4)
    for _ in range(2):
        upsert(spark, "t_null", frame([(str(i), 5) for i in range(20)] + [(None, 6)], ddl))
    rows = [(None, 1), (None, 2), ("", 3), ("a", 4), (None, 6), (None, 6)] + [(str(i), 5) for i in range(20)]
    assert rows_of(read(spark, "t_null")) == sorted(rows, key=repr)
    every = read(spark, "t_null")
    merge_into(spark, "t_null", ddl, ["k"], settle(every), lambda rows: rows.filter("v = 4"))
    assert rows_of(read(spark, "t_null")) == [("a", 4)]
    merge_into(spark, "t_null", ddl, ["k"], frame([("z", 9)], ddl), lambda rows: merge(rows, frame([("z", 9)], ddl), "k"), anew=True)
    assert rows_of(read(spark, "t_null")) == [("z", 9)]


def test_rows_outside_the_named_partitions_fail(spark, frame):
    ddl = "k string, v int"
    upsert(spark, "t_out", frame([("a", 1)], ddl), parts=64)
    with pytest.raises(Exception, match="falls outside"):
        merge_into(spark, "t_out", ddl, ["k"], frame([("a", 2)], ddl), lambda rows: merge(rows, frame([("b", 2)], ddl), "k"))
    assert rows_of(read(spark, "t_out")) == [("a", 1)]


def summary_inputs(spark, frame, amount, day):
    payments = frame(
        [("p1", "a", "10", day), ("p2", "b", amount, day)],
        "payment_id string, application_id string, amount string, day string",
    ).select(
        "payment_id", "application_id", F.col("day").cast("date").alias("payment_date"),
        F.col("amount").cast("decimal(18,2)").alias("payment_amount"), F.lit("ok").alias("payment_status"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("src_load_ts"),
    )
    return payments, empty(spark, schemas.APPLICATION)


def test_a_closed_version_that_returns_is_taken_out_of_its_part(spark, frame):
    """b: 1 -> 2 -> 3 -> 1. The last load brings back a closed version."""
    name, whole = "t_summary", empty(spark, schemas.PAYMENT_SUMMARY)
    for n, amount in enumerate(["1", "2", "3", "1"]):
        payments, applications = summary_inputs(spark, frame, amount, "2024-01-01")
        payments = payments.withColumn("src_load_ts", F.col("src_load_ts") + F.make_dt_interval(F.lit(n)))
        run = {"batch_id": str(n), "now": f"2024-02-0{n + 1}"}
        publish_summary(spark, name, payments, applications, parts=4, **run)
        whole = settle(load_summary(whole, payments, applications, **run))
        assert rows_of(read(spark, name)) == rows_of(whole)
    got = read(spark, name).filter("application_id = 'b'").orderBy("start_ts")
    assert [(int(r["total_payments"]), r["active_flg"]) for r in got.collect()] == [(2, "N"), (3, "N"), (1, "Y")]


def test_versions_are_written_behind_their_one_shuffle(spark, frame, monkeypatch):
    """Only rows that take no part in a load are gathered apart."""
    seen = []
    plain = parted.Laying

    def laying(place_of, gather):
        return plain(place_of, lambda rows: seen.append(rows.count()) or gather(rows))

    monkeypatch.setattr(parted, "Laying", laying)
    for n, amount in enumerate(["1", "2"]):
        payments, applications = summary_inputs(spark, frame, amount, "2024-01-01")
        publish_summary(spark, "t_once", payments, applications, parts=4, batch_id=str(n), now=f"2024-02-0{n + 1}")
    assert seen == [0, 0]
    assert read(spark, "t_once").filter("hash_sk = sha2(application_id, 256)").count() == 0
    assert read(spark, "t_once").filter("hash_sk = sha2(upper(application_id), 256)").count() == 3
    drop(spark, "t_once")


def test_sums_fold_alike_in_one_shuffle_and_apart(spark, frame, monkeypatch):
    ddl = schemas.PAYMENT_SUMS.replace("hash_sk string, ", "")
    entity = hash_key(["application_id"]).alias("hash_sk")
    at, late = datetime(2024, 1, 1), datetime(2024, 1, 2)

    def sums(*rows):
        made = [(a, at.date(), "ok", t, Decimal(v), n, n, Decimal(b)) for a, t, v, n, b in rows]
        return frame(made, ddl).select(entity, "*")

    old = sums(("a", at, 3, 2, 1), ("a", late, 1, 1, 1), ("b", at, 5, 1, 2), ("c", at, 7, 1, 1), ("e", at, 0, 0, 1))
    old = old.withColumn(parted.PART, F.lit(0))
    new = sums(("a", at, -3, -2, 2), ("A", at, 2, 1, 2), ("b", at, 9, 1, 2), ("d", late, 4, 1, 2))
    folded = fold(old, new)
    assert folded._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = rows_of(folded, "application_id", "src_load_ts", "amount", "payments", "batch_id")
    assert got == sorted([
        ("a", at, Decimal("0.00"), 0, Decimal(2)), ("a", late, Decimal("1.00"), 1, Decimal(2)), ("A", at, Decimal("2.00"), 1, Decimal(2)),
        ("b", at, Decimal("5.00"), 1, Decimal(2)), ("c", at, Decimal("7.00"), 1, Decimal(1)), ("d", late, Decimal("4.00"), 1, Decimal(2)),
        ("e", at, Decimal("0.00"), 0, Decimal(1)),
    ], key=repr)
    monkeypatch.setattr(neighbours, "GROUP_BYTES", 1)
    assert rows_of(fold(old, new)) == rows_of(folded)
    with pytest.raises(Exception, match="never counted"):
        fold(old, sums(("c", at, 7, -2, 2))).collect()


def test_a_small_increment_rewrites_one_partition(spark):
    """One payment on a table of 5,000 entities; then one that brings a closed version back."""
    def payments(ids, amount, day):
        return ids.select(
            F.concat(F.lit("p"), "id").alias("payment_id"), F.col("id").cast("string").alias("application_id"),
            F.lit(day).cast("date").alias("payment_date"), F.lit(amount).cast("decimal(18,2)").alias("payment_amount"),
            F.lit("ok").alias("payment_status"), F.lit(day).cast("timestamp_ntz").alias("src_load_ts"),
        )

    applications = empty(spark, schemas.APPLICATION)
    loads = [(spark.range(5000), 1, "2024-01-01"), (spark.range(7, 8), 2, "2024-01-02"), (spark.range(7, 8), 1, "2024-01-03")]
    whole, changed = empty(spark, schemas.PAYMENT_SUMMARY), []
    for n, (ids, amount, day) in enumerate(loads):
        run = {"batch_id": str(n), "now": f"2024-02-0{n + 1}"}
        # The increment brings the payments of its day alone, but their date is the first's.
        rows = payments(ids, amount, day).withColumn("payment_date", F.lit("2024-01-01").cast("date"))
        before = files(spark, "t_few") if n else set()
        publish_summary(spark, "t_few", rows, applications, parts=32, **run)
        whole = settle(load_summary(whole, rows, applications, **run))
        changed.append(len({p for p, _ in before ^ files(spark, "t_few")}))
    assert changed == [32, 1, 1]
    assert rows_of(read(spark, "t_few")) == rows_of(whole)


def test_silver_loads_write_their_increment(spark, folder):
    raw = payment_raw(spark, folder)
    first, rest = up_to(raw, MARK[0]), raw.filter(F.col("src_load_ts") > F.lit(MARK[0]).cast("timestamp_ntz"))
    few = rest.limit(20)
    whole = empty(spark, schemas.PAYMENT)
    for n, part in enumerate((first, settle(few), rest)):
        run = {"batch_id": str(n), "now": f"2024-02-0{n + 1}"}
        before = files(spark, "t_silver") if n else set()
        publish_silver(spark, "t_silver", schemas.PAYMENT, part, silver.PAYMENT, parts=256, **run)
        whole = settle(load_silver(whole, part, silver.PAYMENT, **run))
        if n == 1:
            assert len({p for p, _ in before ^ files(spark, "t_silver")}) <= 20
        assert rows_of(read(spark, "t_silver")) == rows_of(whole)


def test_other_tables_with_like_names_are_left_alone(spark, frame):
    publish(frame([(1,)], "n int"), "t_like")
    frame([(9,)], "n int").write.saveAsTable("t_like__archive")
    prune(spark, "t_like", keep=0)
    drop(spark, "t_like")
    assert rows_of(spark.table("t_like__archive")) == [(9,)]
    spark.sql("DROP TABLE t_like__archive")


def test_prune_keeps_what_it_is_told_to(spark, frame):
    for n in range(3):
        publish(frame([(n,)], "n int"), "t_keep")
    prune(spark, "t_keep", keep=5)
    assert len(versions(spark, "t_keep")) == 3
    drop(spark, "t_keep")


def test_two_writers_do_not_lose_rows(spark, frame):
    publish(frame([(1,)], "n int"), "t_writers")
    seen = state_of(spark, "t_writers")
    publish(frame([(2,)], "n int"), "t_writers")
    with pytest.raises(StateChanged):
        publish(frame([(3,)], "n int"), "t_writers", based_on=seen)
    late = []

    def add(rows):
        if not late:  # another writer comes in between
            late.append(publish(frame([(2,), (4,)], "n int"), "t_writers"))
        return rows.unionByName(frame([(5,)], "n int"))

    assert rows_of(update(spark, "t_writers", "n int", add)) == [(2,), (4,), (5,)]


def test_a_bucket_is_one_file(spark, tmp_path):
    table = publish(spark.range(0, 1000, 1, 16), "t_files", bucket_by=["id"], buckets=4)
    assert len(table.inputFiles()) <= 4


def test_settled_frames_of_a_step_go_with_it(spark, frame):
    with settled_for_now(spark):
        inner = settle(frame([(1,)], "n int"))
        path = inner.inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(path)


class _Cluster:
    """A session of default settings on some master."""

    def __init__(self, master, settings):
        self.conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        self.sparkContext = SimpleNamespace(master=master)


def test_a_cluster_must_name_a_shared_folder():
    own = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    assert shared_folder(_Cluster("local[4]", own))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_folder(_Cluster(master, own))
    assert shared_folder(_Cluster("yarn", {"spark.sql.warehouse.dir": "hdfs://n/w/"})) == "hdfs://n/w"
    assert shared_folder(_Cluster("yarn", own | {"spark.checkpoint.dir": "file:///mnt/shared/"})) == "file:///mnt/shared"


def test_partitioned_table_keeps_its_column_order(spark, frame):
    df = frame([("Y", 1), ("N", 2), (None, 3)], "flg string, n int")
    got = publish(df, "t_parts", partition_by=["flg"])
    assert got.columns == ["flg", "n"] and rows_of(got) == rows_of(df)


def test_read_before_the_first_write(spark):
    assert read(spark, "t_absent", schemas.PAYMENT).count() == 0
    with pytest.raises(ValueError):
        read(spark, "t; drop")


def test_bucketed_table_is_merged_without_a_shuffle_of_it(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("k", F.col("o_orderkey").cast("string"))
        table = publish(orders, "t_buckets", bucket_by=["k"], buckets=8)
        source = settle(orders.withColumn("o_totalprice", F.lit(0.0)))
        plan = merge(table, source, "k", duplicates="trust")
        text = plan._jdf.queryExecution().executedPlan().toString()
        # Only the increment moves, and once.
        assert text.count("Exchange hashpartitioning") == 1
        assert "FullOuter" in text
        assert plan.filter("o_totalprice = 0").count() == orders.count() == plan.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_and_replace_partitions(spark, frame, tmp_path):
    folder = str(tmp_path / "log")
    append(frame([(1, "a")], "b int, v string"), folder)
    append(frame([(2, "b")], "b int, v string"), folder)
    assert rows_of(spark.read.parquet(folder)) == [(1, "a"), (2, "b")]
    parts = str(tmp_path / "parts")
    replace_partitions(frame([("a", 1), ("b", 2)], "v string, b int"), parts, ["b"])
    replace_partitions(frame([("c", 2)], "v string, b int"), parts, ["b"])
    assert rows_of(spark.read.parquet(parts)) == [("a", 1), ("c", 2)]


def test_settle_uses_the_shared_folder(spark, frame):
    got = settle(frame([(1,)], "n int"))
    assert rows_of(got) == [(1,)]
    assert spark.conf.get("spark.checkpoint.dir") in got.inputFiles()[0]


def up_to(df, mark):
    return df.filter(F.col("src_load_ts") <= F.lit(mark).cast("timestamp_ntz"))


def layout(name, **options):
    tables = {t: f"{name}_{t}" for t in ("applications", "payments", "summary", "ledger", "audit")}
    return Layout(**tables, **options)


def state(spark, names):
    """All tables without the columns that tell when rows were written."""
    return [
        rows_of(read(spark, t).drop("batch_id", "etl_load_ts", "etl_updt_ts"))
        for t in (names.applications, names.payments, names.summary)
    ]


@pytest.mark.parametrize("parts", [4, 64])
def test_batches_end_to_end(spark, folder, parts):
    applications, payments = application_raw(spark, folder), payment_raw(spark, folder)
    names = layout(f"e2e{parts}", parts=parts)
    first = run_batch(spark, up_to(applications, MARK[0]), up_to(payments, MARK[0]), "loans", "2024-02-01 00:00:00", names)
    second = run_batch(spark, applications, payments, "loans", "2024-02-02 00:00:00", names)
    assert (first, second) == ("20240201000000000000000", "20240202000000000000000")

    ledger = read(spark, names.ledger)
    assert rows_of(ledger, "batch_status") == [("completed",), ("completed",)]
    audit = read(spark, names.audit)
    assert rows_of(audit, "model_load_status") == [("completed",)] * 6
    newest = payments.agg(F.max("src_load_ts")).first()[0]
    marks = audit.filter((F.col("batch_id") == second) & (F.col("model_id") != names.applications))
    assert {r["inc_load_ts"] for r in marks.collect()} == {newest}
    loaded = marks.filter(F.col("model_id") == names.payments).first()
    silver_rows = read(spark, names.payments).filter(F.col("batch_id") == second)
    assert loaded["rows_inserted"] + loaded["rows_updated"] == silver_rows.count()
    assert loaded["rows_updated"] > 0

    summary = read(spark, names.summary)
    open_rows = summary.filter("active_flg = 'Y'")
    entities = summary.select("hash_sk").distinct().count()
    assert open_rows.count() == entities == open_rows.select("hash_sk").distinct().count()
    assert summary.count() > entities
    assert summary.filter("active_flg = 'N' and (end_ts is null or end_ts < start_ts)").count() == 0

    before = state(spark, names)
    run_batch(spark, applications, payments, "loans", "2024-02-03 00:00:00", names)
    assert state(spark, names) == before


def test_a_batch_with_deletes_quality_and_drift(spark, folder, frame):
    applications, payments = application_raw(spark, folder), payment_raw(spark, folder)
    names = layout("steps")
    run_batch(spark, applications, up_to(payments, MARK[0]), "loans", "2024-02-01 00:00:00", names)
    gone = [r[0] for r in read(spark, names.payments).select("payment_id").orderBy("payment_id").limit(3).collect()]
    closed = read(spark, names.summary).filter("active_flg = 'Y'").orderBy("application_id").first()["application_id"]
    now = datetime(2024, 2, 1)

    def changes(keys):
        return frame(
            [(k, now, 1, "IncrementalDeleteRows") for k in keys],
            "primary_key__pk string, seen_at timestamp_ntz, least_significant_position int, event_type string",
        )

    expectation = {c: c for c in (
        "project_id project_name group_id group_name rule_id rule_name rule_type exp_message schema_name tbl_name "
        "full_tbl_name col_name severity_level source_system escalation_poc").split()}
    rows = [
        {**expectation, "exp_id": "ids", "dbt_test": "dq_rule_not_null",
         "param_value": json.dumps({"table_name": names.payments, "column_name": "payment_id"})},
        {**expectation, "exp_id": "gone", "dbt_test": "dq_rule_not_null",
         "param_value": json.dumps({"table_name": "no_such_table", "column_name": "x"})},
    ]
    expectations = settle(spark.createDataFrame(rows))
    steps = [
        delete_step(changes(gone), "steps_deletes", names.payments, "payment_id", group="silver"),
        delete_step(changes([closed]), "steps_deletes", names.summary, "application_id", group="gold", history=True),
        quality_step(expectations, "steps_results"),
        drift_step({names.payments: read(spark, names.payments).drop("payment_status")}, "steps_drift", "silver"),
    ]
    before = read(spark, names.payments).count()
    for day in ("02", "03"):  # a delete that is logged already changes nothing
        batch = run_batch(spark, applications, up_to(payments, MARK[0]), "loans", f"2024-02-{day} 00:00:00", names, steps)
        of_batch = F.col("batch_id") == F.lit(batch).cast("decimal(38,0)")
        assert read(spark, names.payments).filter(F.col("payment_id").isin(gone)).count() == 0
        assert read(spark, names.payments).count() == before - 3
        left = read(spark, names.summary).filter(F.col("application_id") == closed)
        assert rows_of(left, "active_flg") == [("N",)]
        assert rows_of(read(spark, "steps_drift").filter(of_batch), "column_name", "diff_type") == [("payment_status", "MISSING_IN_SOURCE")]
        results = {r["exp_id"]: r["result_status"] for r in read(spark, "steps_results").filter(of_batch).collect()}
        assert results == {"ids": "Success", "gone": "Error"}
    assert read(spark, "steps_deletes").count() == 4


def test_a_broken_batch_is_taken_up_again(spark, folder):
    names = layout("broken")
    applications, payments = application_raw(spark, folder), payment_raw(spark, folder)
    bad = payments.withColumn("raw_json", F.parse_json(F.lit('{"payment_date": "soon"}')))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        run_batch(spark, applications, bad, "loans", "2024-02-01 00:00:00", names)
    assert open_batch(spark, names.ledger, "loans", "2024-02-05 00:00:00") == "20240201000000000000000"
    assert run_batch(spark, applications, payments, "loans", "2024-02-02 00:00:00", names) == "20240201000000000000000"
    fresh = layout("whole")
    run_batch(spark, applications, payments, "loans", "2024-02-01 00:00:00", fresh)
    assert state(spark, names) == state(spark, fresh)


def test_a_stopped_batch_shows_what_was_queued(spark, folder):
    names = layout("queued", parts=4)
    applications, payments = application_raw(spark, folder), payment_raw(spark, folder)
    bad = payments.withColumn("raw_json", F.parse_json(F.lit('{"payment_date": "soon"}')))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        run_batch(spark, applications, bad, "loans", "2024-02-01 00:00:00", names)
    audit = {r["model_id"]: r["model_load_status"] for r in read(spark, names.audit).collect()}
    assert audit == {names.applications: "completed", names.payments: "running", names.summary: "yet to start"}
    counted = rows_of(read(spark, names.audit).filter(F.col("model_id") == names.applications), "rows_inserted", "inc_load_ts")
    run_batch(spark, applications, payments, "loans", "2024-02-02 00:00:00", names)
    # What the first attempt loaded is still counted.
    assert rows_of(read(spark, names.audit).filter(F.col("model_id") == names.applications), "rows_inserted", "inc_load_ts") == counted
    assert rows_of(read(spark, names.audit), "model_load_status") == [("completed",)] * 3


def test_full_reload_and_statements_of_a_batch(spark, folder, frame):
    names = layout("reload", parts=4)
    names = layout("reload", parts=4, full_reload=(names.applications,))
    applications, payments = application_raw(spark, folder), payment_raw(spark, folder)
    text = f"merge into {names.payments} using 'x'"
    statements = frame(
        [("q1", text, "MERGE", datetime(2024, 2, 2)), ("q0", "select 1", "SELECT", datetime(2024, 2, 2))],
        "query_id string, query_text string, query_type string, end_time timestamp_ntz",
    )
    run_batch(spark, applications, payments, "loans", "2024-02-01 00:00:00", names)
    some = applications.filter(F.col("src_load_ts") <= F.lit(MARK[0]).cast("timestamp_ntz"))
    batch = run_batch(spark, some, payments, "loans", "2024-02-02 00:00:00", names, statements=statements)
    assert read(spark, names.applications).count() == some.count()
    audit = {r["model_id"]: r for r in read(spark, names.audit).filter(F.col("batch_id") == F.lit(batch).cast("decimal(38,0)")).collect()}
    reloaded, other = audit[names.applications], audit[names.payments]
    assert (reloaded["rows_inserted"], reloaded["rows_updated"], reloaded["inc_load_ts"]) == (some.count(), 0, None)
    assert (other["query_id"], other["query_text"]) == ("q1", text.replace("'", "''"))
    assert other["rows_inserted"] is None  # nothing new


def test_watermark_is_strict_and_reaches_the_scan(spark, frame, folder):
    start = datetime(2024, 1, 1)
    rows = frame([(i, start + timedelta(days=i)) for i in range(3)], "n int, src_load_ts timestamp_ntz")
    assert rows_of(silver.above_watermark(rows, start + timedelta(days=1)), "n") == [(2,)]
    assert silver.above_watermark(rows, None).count() == 3
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_orderdate", "src_load_ts")
    plan = silver.above_watermark(orders, MARK[0]).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan


def test_stream_of_raw_files(spark, folder, tmp_path):
    raw = payment_raw(spark, folder)
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    ddl = "payment_id string, src_load_ts timestamp_ntz, raw_json variant"
    step = silver_increment("streamed", schemas.PAYMENT, silver.PAYMENT, "1", "2024-02-01")

    def follow():
        query = follow_raw(spark, landing, ddl, step, checkpoint, files_per_increment=1)
        query.awaitTermination()
        assert query.exception() is None

    # The newer half lands first: a file that is late is loaded all the same.
    new = raw.filter(F.col("src_load_ts") > F.lit(MARK[0]).cast("timestamp_ntz"))
    new.coalesce(1).write.mode("append").parquet(landing)
    follow()
    up_to(raw, MARK[0]).coalesce(1).write.mode("append").parquet(landing)
    follow()
    loaded = read(spark, "streamed")
    assert loaded.count() == raw.select("payment_id").distinct().count()
    follow()
    assert rows_of(read(spark, "streamed")) == rows_of(loaded)
