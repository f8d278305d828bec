import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import (
    batch_id_from,
    delete_table_name,
    failure_ratio,
    fields_from_payload,
    hash_key,
    iso_text,
    moment,
    name_parts,
    result_status,
    strip_key_list,
    table_for_view,
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_hash_key_normalises_text(frame):
    df = frame([(" ab ", 1), (None, 2), ("", 3), ("  ", 4), ("AB", 5)], "a string, n int")
    got = [r[0] for r in df.orderBy("n").select(hash_key(["a"])).collect()]
    assert got == [sha("AB"), sha("^^"), sha("^^"), sha("^^"), sha("AB")]


def test_hash_key_of_an_empty_pair_is_null_and_only_of_a_pair(frame):
    df = frame([(None, "", None)], "a string, b string, c string")
    assert df.select(hash_key(["a", "b"])).first()[0] is None
    assert df.select(hash_key(["a", "b", "c"])).first()[0] == sha("^^||^^||^^")


def test_hash_key_keeps_tabs_and_casts(frame):
    df = frame([("\tx", Decimal("1.50"), datetime(2024, 1, 2))], "a string, b decimal(18,2), c timestamp_ntz")
    got = df.select(hash_key(["a", "b", F.col("c").cast("date")])).first()[0]
    assert got == sha("\tX||1.50||2024-01-02")


def test_hash_key_needs_columns():
    with pytest.raises(ValueError):
        hash_key([])


def test_names(frame):
    df = frame([('"db".s.pay_v',), ("db.s.pay_V",), ("db.s.pay_t",), ("vv_v_v",)], "n string")
    assert [r[0] for r in df.select(table_for_view("n")).collect()] == [
        '"db".s.pay_t', "db.s.pay_t", "db.s.pay_t", "vv_v_t"
    ]
    parts = df.select(name_parts("n").alias("p")).select("p.*").collect()
    assert tuple(parts[0]) == ("db", "s", "pay_v")
    assert tuple(parts[3]) == ("vv_v_v", None, None)
    one = frame([("pay_t", "['a', 'b']")], "n string, k string")
    assert tuple(one.select(delete_table_name("n"), strip_key_list("k")).first()) == ("pay_del_t", "a, b")


def test_batch_id_and_times(frame):
    df = frame([(datetime(2024, 2, 3, 4, 5, 6, 7000),)], "ts timestamp_ntz")
    assert df.select(batch_id_from(F.col("ts"))).first()[0] == Decimal("20240203040506007000000")
    assert df.select(iso_text(F.col("ts"))).first()[0] == "2024-02-03T04:05:06.007"
    assert df.select(moment(datetime(2024, 1, 1))).first()[0] == datetime(2024, 1, 1)
    assert df.select(moment("2024-01-01 10:00:00")).first()[0] == datetime(2024, 1, 1, 10)
    assert df.select(moment(None)).first()[0] is None


def test_payload_fields(spark):
    df = spark.sql(
        """SELECT '{"id": 7, "day": "2024-05-06", "amount": "1.005", "more": {"x": 1}}' AS raw
           UNION ALL SELECT '{"amount": 12.345}'"""
    )
    cols = fields_from_payload(
        df, "raw", {"id": "string", "day": "date", "amount": "decimal(18,2)", "none": "string"}
    )
    got = rows_of(df.select(*[c.alias(n) for n, c in cols.items()]))
    assert [str(v) for v in got[0]] == ["7", "2024-05-06", "1.01", "None"]
    assert [str(v) for v in got[1]] == ["None", "None", "12.35", "None"]


def test_payload_bad_cast_fails(spark):
    df = spark.sql("""SELECT parse_json('{"day": "soon"}') AS raw""")
    cols = fields_from_payload(df, "raw", {"day": "date"})
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.select(cols["day"]).collect()


def test_scores(frame):
    df = frame([(0, 0), (1, 4), (0, 4)], "failed long, total long")
    got = rows_of(df.select(failure_ratio(F.col("failed"), F.col("total")), result_status(F.col("failed"))))
    assert got == [(0.0, "Success"), (0.0, "Success"), (25.0, "Fail")]
