"""The summary that follows loads, deletes and late payments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans.gold import settle_summary
from tidemark.plans.totals import Followed, delete_payments, load_payments, totals
from tidemark.sources.tables import drop, read, settle
from workload import silver_gold
from workload.common import BATCH, MARK, NOW, payment_raw, portable
from workload.silver_gold import _APP, _HASH_PARTS, _PAY, _applications, _latest

# Payments of every seventh application go, and every third line of the others.
_GONE = "order_no % 7 = 0 OR line_no % 3 = 0"


def _followed(spark, folder):
    """A load, deletes among its payments, and a load of the rest, which brings payments of
    applications back that had none left."""
    run = uuid.uuid4().hex
    names = Followed(*[f"{t}_{run}" for t in ("payments", "sums", "deltas", "summary")], parts=16)
    applications = settle(_applications(spark, folder))
    raw = payment_raw(spark, folder)
    first, later, latest = silver_gold._loads(raw)
    numbers = F.split("payment_id", "-")
    gone = raw.select("payment_id", numbers[0].cast("long").alias("order_no"), numbers[1].cast("int").alias("line_no"))
    load_payments(spark, names, first, applications, batch_id=BATCH[0], now=NOW[0])
    delete_payments(spark, names, gone.filter(_GONE), applications, batch_id=BATCH[1], now=NOW[1])
    load_payments(spark, names, later.unionByName(latest), applications, batch_id=BATCH[2], now=NOW[2])
    return names


def gold_follows_deletes(spark, folder):
    """The history of the summary over the three changes."""
    names = _followed(spark, folder)
    try:
        return portable(settle_summary(read(spark, names.summary)))
    finally:
        for name in names.tables:
            drop(spark, name)


def gold_kept_totals(spark, folder):
    """Totals from the partial sums that are left after the three changes."""
    names = _followed(spark, folder)
    try:
        return portable(settle(totals(read(spark, names.sums))))
    finally:
        for name in names.tables:
            drop(spark, name)


QUERIES = {"gold_follows_deletes": gold_follows_deletes, "gold_kept_totals": gold_kept_totals}

# ------------------------------------------------------------------------- SQL

_TOTALS = """application_id, sum(payment_amount) AS total_payments, max(payment_date) AS latest_payment_date,
         count(*) AS num_payments, max(payment_status) AS last_status, max(src_load_ts) AS src_load_ts"""

_STATES = f"""
WITH {_APP}, {_PAY},
load0 AS (SELECT * FROM pay WHERE src_load_ts <= TIMESTAMP '{MARK[0]}'),
load2 AS (SELECT * FROM pay WHERE src_load_ts > TIMESTAMP '{MARK[0]}'),
state0 AS ({_latest('load0')}),
numbered AS (
  SELECT *, CAST(split_part(payment_id, '-', 1) AS BIGINT) AS order_no,
    CAST(split_part(payment_id, '-', 2) AS INTEGER) AS line_no FROM state0),
state1 AS (SELECT * EXCLUDE (order_no, line_no) FROM numbered WHERE NOT ({_GONE})),
fresh AS ({_latest('load2')}),
state2 AS (
  SELECT * FROM state1 WHERE payment_id NOT IN (SELECT payment_id FROM fresh) UNION ALL SELECT * FROM fresh)"""

SQL = {
    "gold_kept_totals": f"""{_STATES}
SELECT application_id, CAST(total_payments AS DOUBLE) AS total_payments,
  CAST(latest_payment_date AS VARCHAR) AS latest_payment_date, num_payments, last_status, src_load_ts
FROM (SELECT {_TOTALS} FROM state2 GROUP BY application_id)""",
    "gold_follows_deletes": f"""{_STATES},
touched1 AS (SELECT DISTINCT application_id FROM numbered WHERE {_GONE}),
touched2 AS (
  SELECT application_id FROM fresh
  UNION SELECT application_id FROM state1 WHERE payment_id IN (SELECT payment_id FROM fresh)),
totals AS (
  SELECT 0 AS load_no, * FROM (SELECT {_TOTALS} FROM state0 GROUP BY application_id)
  UNION ALL SELECT 1, * FROM (SELECT {_TOTALS} FROM state1 GROUP BY application_id)
    WHERE application_id IN (SELECT application_id FROM touched1)
  UNION ALL SELECT 2, * FROM (SELECT {_TOTALS} FROM state2 GROUP BY application_id)
    WHERE application_id IN (SELECT application_id FROM touched2)),
hashed AS (
  SELECT *, sha256(coalesce(nullif(upper(trim(application_id)), ''), '^^')) AS hash_sk,
    sha256({_HASH_PARTS}) AS hash_seq_num
  FROM (SELECT t.*, a.customer_id, a.application_date, a.amount_requested, a.property_type, a.status AS application_status
        FROM totals t LEFT JOIN app a USING (application_id))),
merged AS (
  SELECT *, min(load_no) OVER (PARTITION BY hash_sk, hash_seq_num) AS first_no FROM hashed
  QUALIFY row_number() OVER (PARTITION BY hash_sk, hash_seq_num ORDER BY load_no DESC) = 1),
closed AS (
  SELECT m.*, lead(load_no) OVER (PARTITION BY hash_sk ORDER BY load_no, hash_seq_num) AS next_no,
    load_no = 0 AND application_id IN (SELECT application_id FROM touched1)
      AND application_id NOT IN (SELECT application_id FROM state1) AS ended
  FROM merged m),
timed AS (
  SELECT *, CASE load_no {' '.join(f"WHEN {i} THEN TIMESTAMP '{n}'" for i, n in enumerate(NOW))} END AS start_ts,
    CASE next_no {' '.join(f"WHEN {i} THEN TIMESTAMP '{n}'" for i, n in enumerate(NOW))} END AS next_ts
  FROM closed)
SELECT application_id, CAST(total_payments AS DOUBLE) AS total_payments,
  CAST(latest_payment_date AS VARCHAR) AS latest_payment_date, num_payments, last_status, customer_id,
  CAST(application_date AS VARCHAR) AS application_date, CAST(amount_requested AS DOUBLE) AS amount_requested,
  property_type, application_status, src_load_ts, hash_sk, hash_seq_num, start_ts,
  CASE WHEN ended THEN start_ts ELSE next_ts END AS end_ts,
  CASE WHEN ended OR next_no IS NOT NULL THEN 'N' ELSE 'Y' END AS active_flg,
  CASE WHEN NOT ended AND next_no IS NOT NULL THEN 'N' ELSE 'Y' END AS reporting_flg,
  CASE load_no {' '.join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BATCH))} END AS batch_id,
  CASE first_no {' '.join(f"WHEN {i} THEN TIMESTAMP '{n}'" for i, n in enumerate(NOW))} END AS etl_load_ts,
  start_ts AS etl_updt_ts
FROM timed""",
}
