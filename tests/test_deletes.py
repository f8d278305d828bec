import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import deletes as deletes_module
from tidemark.operators.bands import Within
from tidemark.operators.deletes import (
    capture_deletes,
    count_deletes,
    delete_hard,
    delete_hard_logged,
    delete_soft,
    delete_soft_logged,
    logged_keys,
)
from tidemark.sources import schemas
from tidemark.sources.tables import empty

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
CDC = "primary_key__pk string, seen_at timestamp_ntz, least_significant_position long, event_type string"
TABLE = "id long, grp string, active_flg string, reporting_flg string, end_ts timestamp_ntz, etl_updt_ts timestamp_ntz"


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    """Both join plans."""
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def capture(changes, log, now="2024-02-01", batch="7"):
    return capture_deletes(
        changes, log, model_id=F.lit("db.s.pay_t"), model_grp=F.lit("g"), pipeline_name=F.lit("p"),
        batch_id=batch, now=now,
    )


def test_capture_takes_the_latest_delete_only(spark, frame):
    gone = "IncrementalDeleteRows"
    changes = frame(
        [("1", T1, 1, gone), ("1", T3, 2, gone), ("1", T3, 3, gone), ("2", T2, 1, "IncrementalInsertRows"),
         (None, T1, 1, gone), (None, T2, 2, gone), ("", T1, 1, gone)],
        CDC,
    )
    log = capture(changes, empty(spark, schemas.DELETION_LOG))
    assert rows_of(log, "pk", "src_load_ts") == [("", T1), ("1", T3), (None, T2)]
    again = capture(changes, log, now="2024-03-01", batch="8")
    # Known keys only get a new update time; a NULL key never matches and is logged again.
    got = {(r["pk"], int(r["batch_id"])): (r["etl_load_ts"].month, r["etl_updt_ts"].month) for r in again.collect()}
    assert got == {("", 7): (2, 3), ("1", 7): (2, 3), (None, 7): (2, 2), (None, 8): (3, 3)}


def people(frame):
    return frame(
        [(1, "a", "Y", "Y", None, T1), (2, "a", "N", "N", T1, T2), (3, "b", "Y", "Y", None, T3),
         (None, "a", "Y", "Y", None, T1), (3, "c", None, "Y", None, T2)],
        TABLE,
    )


def log_of(frame, *keys):
    return frame([("DB.s.pay_t", k) for k in keys] + [("db.s.other_t", "2")], "model_id string, pk string")


def test_logged_keys_ignore_case_views_and_bad_keys(frame):
    log = log_of(frame, "1", "3", "3", "x", None)
    assert rows_of(logged_keys(log, "db.s.PAY_v", people(frame), "id")) == [(1,), (3,)]


def test_hard_delete(frame, joins):
    log = log_of(frame, "1", "3", "x")
    kept = delete_hard_logged(people(frame), log, "db.s.pay_v", "id")
    assert rows_of(kept, "id") == [(2,), (None,)]
    assert rows_of(delete_hard_logged(kept, log, "db.s.pay_v", "id")) == rows_of(kept)
    assert count_deletes(people(frame), log, "db.s.pay_t", "id").first()[0] == 3


def test_soft_delete_closes_active_rows_at_their_last_update(frame, joins):
    got = delete_soft_logged(people(frame), log_of(frame, "1", "2", "3"), "db.s.pay_t", "id")
    assert rows_of(got, "id", "active_flg", "reporting_flg", "end_ts") == [
        (1, "N", "Y", T1), (2, "N", "N", T1), (3, "N", "Y", T3), (3, None, "Y", None), (None, "Y", "Y", None)
    ]


@pytest.mark.parametrize("soft", [False, True])
def test_predicate_over_both_tables(frame, joins, soft):
    gone = frame([(1, T2), (1, T3), (3, T1)], "pk long, at timestamp_ntz")
    late = F.col("s.at") > F.col("t.etl_updt_ts")
    if soft:
        got = delete_soft(people(frame), gone, {"id": "pk"}, late)
        assert [r[0] for r in rows_of(got.filter("active_flg = 'N'"), "id")] == [1, 2]
        assert got.count() == 5
    else:
        assert rows_of(delete_hard(people(frame), gone, {"id": "pk"}, late), "id") == [(2,), (3,), (3,), (None,)]


def test_composite_keys(frame, joins):
    gone = frame([(3, "c"), (None, "a")], "pk long, g string")
    kept = delete_hard(people(frame), gone, {"id": "pk", "grp": "g"})
    assert rows_of(kept, "id", "grp") == [(1, "a"), (2, "a"), (3, "b"), (None, "a")]


def test_a_delete_needs_a_key(frame):
    with pytest.raises(ValueError):
        delete_hard(people(frame), people(frame), {}, F.lit(True))


def test_deleted_and_kept_rows_make_up_the_table(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    gone = orders.filter("o_orderstatus = 'F'").select("o_custkey")
    kept = delete_hard(orders, gone, {"o_custkey": "o_custkey"})
    dropped = orders.join(gone.distinct(), "o_custkey", "left_semi")
    assert kept.count() + dropped.count() == orders.count()


RANGES = "low double, high double, g string"


def _ranged(frame, kind):
    rng = random.Random(5)
    values = [rng.uniform(-1000, 1000) for _ in range(300)] + [0.0, -5.0, 5.0, None, float("nan"), float("inf")]
    rows = frame([(v, rng.choice("ab"), "Y", "Y", None, T1) for v in values], "x double, grp string, active_flg string, reporting_flg string, end_ts timestamp_ntz, etl_updt_ts timestamp_ntz")
    spans = [(a, a + rng.choice([0, 1, 3, 500]), rng.choice("ab")) for a in (rng.uniform(-1000, 1000) for _ in range(60))]
    spans += [(5.0, 5.0, "a"), (9.0, 1.0, "a"), (None, 4.0, "a"), (4.0, None, "b"), (float("nan"), 3.0, "b"), spans[0]]
    casts = {"double": lambda c: F.col(c), "bigint": lambda c: F.when(F.abs(F.col(c)) < 1e9, F.round(c)).cast("long"),
             "date": lambda c: F.when(F.abs(F.col(c)) < 1e9, F.date_add(F.lit("2024-01-01").cast("date"), F.round(c).cast("int"))),
             "ntz": lambda c: F.when(F.abs(F.col(c)) < 1e9, F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.round(c, 3).cast("decimal(18,6)")))}
    cast = casts[kind]
    ranges = frame(spans, RANGES).withColumn("low", cast("low")).withColumn("high", cast("high"))
    return rows.withColumn("x", cast("x")), ranges


@pytest.mark.parametrize("kind", ["double", "bigint", "date", "ntz"])
def test_ranges_equal_every_pair_compared(frame, kind):
    rows, ranges = _ranged(frame, kind)
    spans = [r for r in ranges.collect() if r["low"] is not None and r["high"] is not None and r["low"] == r["low"]]

    def covered(r, same):
        x = r["x"]
        if x is None or x != x or x == float("inf"):
            return False
        return any(s["low"] <= x <= s["high"] and (not same or s["g"] == r["grp"]) for s in spans)

    within, same = Within("x", "low", "high"), F.col("s.g") == F.col("t.grp")
    every = rows.collect()
    for condition in (None, same):
        want = sorted((repr(r["x"]) for r in every if not covered(r, condition is not None)))
        kept = delete_hard(rows, ranges, {}, condition, within=within)
        assert kept.columns == rows.columns
        assert sorted(repr(r["x"]) for r in kept.collect()) == want
        soft = delete_soft(rows, ranges, {}, condition, within=within)
        assert soft.columns == rows.columns
        assert sorted(repr(r["x"]) for r in soft.filter("active_flg = 'Y'").collect()) == want
        assert soft.count() == len(every)


def test_ranges_are_joined_by_bins(frame, joins):
    rows, ranges = _ranged(frame, "double")
    for plan in (delete_hard(rows, ranges, {}, within=Within("x", "low", "high")),
                 delete_soft(rows, ranges, {}, within=Within("x", "low", "high"))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_ranges_beside_keys(frame):
    gone = frame([(1, T1, T2), (3, T1, T2)], "pk long, a timestamp_ntz, b timestamp_ntz")
    kept = delete_hard(people(frame), gone, {"id": "pk"}, within=Within("etl_updt_ts", "a", "b"))
    assert rows_of(kept, "id", "etl_updt_ts") == [(2, T2), (3, T3), (None, T1)]


def test_a_soft_delete_on_a_condition_is_one_join(frame, joins):
    gone = frame([(1, T2), (1, T3), (3, T1)], "pk long, at timestamp_ntz")
    plan = delete_soft(people(frame), gone, {"id": "pk"}, F.col("s.at") > F.col("t.etl_updt_ts"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ExistenceJoin") == 1 and "LeftSemi" not in text and "LeftAnti" not in text


def test_a_later_filter_does_not_repeat_a_soft_delete(frame, joins):
    gone = frame([(1,), (3,)], "pk long")
    closed = delete_soft(people(frame), gone, {"id": "pk"}).filter("active_flg = 'Y' OR reporting_flg = 'Y'")
    text = closed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("= pk#") == 1 and "ExistenceJoin" not in text


def test_soft_deletes_above_the_limit_go_around_the_join(spark, joins):
    rows = spark.range(3000).selectExpr(
        "id", "CAST(id % 2 AS string) AS grp", "if(id % 3 = 0, 'N', 'Y') AS active_flg", "'Y' AS reporting_flg",
        "CAST(NULL AS timestamp_ntz) AS end_ts", "timestamp_ntz'2024-01-01' AS etl_updt_ts",
    )
    gone = spark.range(0, 6000, 5).withColumnRenamed("id", "pk")
    got = delete_soft(rows, gone.unionByName(gone), {"id": "pk"})
    assert got.count() == 3000 and got.filter("active_flg = 'N' AND end_ts IS NULL AND id % 5 = 0").count() == 200
    assert got.filter("active_flg = 'N' AND end_ts IS NOT NULL").count() == 400
    assert got.filter("active_flg = 'Y'").count() == 1600


def test_keys_that_fit_as_files_alone_are_not_broadcast(spark, frame):
    """Spark's estimate of a key column is of compressed files; the driver holds its rows."""
    from tidemark.operators.sizing import broadcast_limit, joined_bytes, planned_bytes, small_side
    from tidemark.sources.tables import settle

    gone = settle(spark.range(20000).selectExpr("CAST(id AS string) AS name", "sha2(CAST(id AS string), 256) AS hash_sk", "1 AS n"), {
        "hash_sk": F.sha2("name", 256)}).select("hash_sk")
    rows = spark.range(30000).selectExpr("sha2(CAST(id AS string), 256) AS hash_sk")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        assert planned_bytes(gone) <= broadcast_limit(gone) < gone.count() * joined_bytes(gone)
        kept = rows.join(small_side(gone), "hash_sk", "left_anti")
        assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 10000
        assert "BroadcastHashJoin" in rows.join(small_side(gone.limit(9)), "hash_sk", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_no_delete_can_match_go_around_the_join(spark, frame):
    """Deletes above the broadcast limit: most rows do not enter the shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(20000).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("v"))
        rows = rows.unionByName(frame([(None, "none")], "k long, v string"))
        gone = spark.range(3000).select((F.col("id") * 14).cast("int").alias("key"))
        kept = delete_hard(rows, gone, {"k": "key"})
        assert kept.count() == 20001 - 3000
        assert kept.filter("k % 14 = 0 AND k < 42000").count() == 0
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and text.count("LeftAnti") == 1
        # What enters the exact join is little more than what it deletes.
        entered = []
        deletes_module._around_sure(rows.filter("k IS NOT NULL"), gone.distinct(), {"k": "key"}, lambda r: entered.append(r.count()) or r)
        assert 3000 <= entered[0] <= 3000 + 17000 / 16 * 1.5
        assert sorted(r[0] for r in delete_hard(rows, gone.limit(0), {"k": "key"}).select("v").collect()) == sorted(r[0] for r in rows.select("v").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
