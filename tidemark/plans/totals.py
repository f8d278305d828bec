"""A summary that follows every change of the payments, deletes included.

Payments change by keys. What a change takes from the totals and what it adds are signed
rows, folded into partial sums that are kept per application; totals and maxima come from the
sums of the applications that changed. No step reads payments of others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.keys import hash_key, hashed_text, pack, unpack, usable_key
from tidemark.functions.times import batch_number, moment
from tidemark.operators.deletes import delete_hard, delete_soft
from tidemark.operators.history import PLACES
from tidemark.operators.neighbours import find_hot_groups, group_rows
from tidemark.operators.sizing import small_side
from tidemark.plans.gold import ENTITY_COLUMNS, ENTITY_KEY, describe, hashes, merge_summary, settle_summary
from tidemark.plans.silver import PAYMENT, merge_silver, silver_rows
from tidemark.sources import schemas
from tidemark.sources.parted import PART, PARTS, Laying, dynamic_overwrite, is_parted, merge_into, parts_of, rows_in
from tidemark.sources.tables import exists, read, settle, settled_for_now

#: Payments that agree in these are one row of the partial sums. A maximum over an
#: application's rows is a maximum over its payments, whichever have left.
GRAIN = ("application_id", "payment_date", "payment_status", "src_load_ts")
SUMMED = ("amount", "amounts", "payments")


@dataclass(frozen=True)
class Followed:
    """Names of the tables: payments, partial sums, the signed rows of each batch, summary."""

    payments: str
    sums: str
    deltas: str
    summary: str
    parts: int = PARTS

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.payments, self.sums, self.deltas, self.summary)


def payment_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns partial sums of the payments ``before`` into those of ``after``; payments that
    are the same in both cancel out and leave no row."""

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        amount = F.col("payment_amount")
        return rows.select(
            *GRAIN,
            (amount * sign).alias("amount"),
            F.when(amount.isNotNull(), sign).otherwise(0).alias("amounts"),
            F.lit(sign).alias("payments"),
        )

    both = signed(before, -1).unionByName(signed(after, 1))
    summed = both.groupBy(*GRAIN).agg(*_sums()).filter(" OR ".join(f"{c} <> 0" for c in SUMMED))
    return summed.select(hash_key(ENTITY_COLUMNS).alias(ENTITY_KEY), "*")


def fold(sums: DataFrame, deltas: DataFrame, laying: Laying | None = None) -> DataFrame:
    """Partial sums with signed rows of one batch folded in.

    An application that has this batch or a later one is left as it is, so folding again
    changes nothing. Where its last payment left, a row with zero payments keeps the batch. A
    count below zero, a payment taken out that was never in, fails the job.

    Sums and signed rows of an application meet behind one shuffle. Where one has very many,
    its rows are spread by all columns that they are folded by, in ``_folded_apart``.
    """
    both = sums.withColumn("__new", F.lit(False)).unionByName(deltas.withColumn("__new", F.lit(True)), allowMissingColumns=True)
    if find_hot_groups(both.select(ENTITY_KEY), [ENTITY_KEY], group_rows(sums)):
        folded = _folded_apart(sums, deltas)
        return folded if laying is None else laying.gather(folded)
    spread = F.xxhash64(F.lit(1), ENTITY_KEY)
    place = F.pmod(spread, F.lit(PLACES)).cast("int") if laying is None else laying.place_of(spread)
    made = {ENTITY_KEY: hash_key(ENTITY_COLUMNS)}
    moved = pack(both.withColumn("__place", place), made).repartition("__place")
    entity = Window.partitionBy(ENTITY_KEY, "__place")
    seen = unpack(moved, made).withColumns(
        {
            "__batch": F.max(F.when(F.col("__new"), F.col("batch_id"))).over(entity),
            "__done": F.max(F.when(~F.col("__new"), F.col("batch_id"))).over(entity),
        }
    )
    due = F.col("__batch").isNotNull() & F.coalesce(F.col("__done") < F.col("__batch"), F.lit(True))
    # A row that stays as it is is a group of its own.
    marked = seen.withColumn("__due", due).filter(F.col("__due") | ~F.col("__new"))
    marked = marked.withColumn("__row", F.when(~F.col("__due"), F.monotonically_increasing_id()))
    folded = marked.groupBy("__place", ENTITY_KEY, *GRAIN, "__due", "__row").agg(
        *_sums(),
        F.max(F.when(F.col("__due"), F.col("__batch")).otherwise(F.col("batch_id"))).alias("batch_id"),
        F.max(PART).alias(PART),
        F.min("payments").alias("__least"),
    )
    return _without_emptied(folded, ~F.col("__due")).select(*sums.columns)


def _folded_apart(sums: DataFrame, deltas: DataFrame) -> DataFrame:
    """``fold`` with the rows of an application in many tasks."""
    changed = deltas.groupBy(ENTITY_KEY).agg(F.max("batch_id").alias("__batch"))
    # Rows of the table's partitions at hand; deltas are few as increments are.
    done = sums.groupBy(ENTITY_KEY).agg(F.max("batch_id").alias("__done"))
    due = settle(changed.join(done, ENTITY_KEY, "left").filter("__done IS NULL OR __done < __batch").drop("__done"))
    others = sums.join(due, ENTITY_KEY, "left_anti").select(*sums.columns)
    mine = sums.join(due, ENTITY_KEY).withColumn("batch_id", F.col("__batch")).select(*sums.columns)
    fresh = deltas.join(due.select(ENTITY_KEY), ENTITY_KEY, "left_semi")
    folded = (
        mine.unionByName(fresh, allowMissingColumns=True)
        .groupBy(ENTITY_KEY, *GRAIN)
        .agg(
            *_sums(),
            F.max("batch_id").alias("batch_id"),
            F.max(PART).alias(PART),
            F.min("payments").alias("__least"),
        )
    )
    return others.unionByName(_without_emptied(folded, F.lit(False)).select(*sums.columns))


def _without_emptied(folded: DataFrame, as_it_was: Column) -> DataFrame:
    """Of rows without payments, those that this batch emptied mark the batch; others go."""
    told = F.concat(F.lit("payments left that were never counted: "), F.col("application_id"))
    below = ~as_it_was & (F.col("payments") < 0)
    checked = folded.withColumn("payments", F.when(below, F.raise_error(told).cast("long")).otherwise(F.col("payments")))
    return checked.filter(as_it_was | (F.col("payments") > 0) | (F.col("__least") < 0))


def totals(sums: DataFrame) -> DataFrame:
    """Totals of the applications that have payments."""
    any_amount = F.sum("amounts") > 0
    return (
        sums.filter("payments > 0")
        .groupBy("application_id")
        .agg(
            F.when(any_amount, F.sum("amount")).alias("total_payments"),
            F.max("payment_date").alias("latest_payment_date"),
            F.sum("payments").alias("num_payments"),
            F.max("payment_status").alias("last_status"),
            F.max("src_load_ts").alias("src_load_ts"),
        )
    )


def load_payments(
    spark: SparkSession, tables: Followed, raw: DataFrame, applications: DataFrame, *, watermark=None, batch_id, now
) -> None:
    """Merge the raw payments above the mark; sums and summary follow."""
    with settled_for_now(spark):
        rows = settle(silver_rows(raw, PAYMENT, watermark=watermark, batch_id=batch_id, now=now))
        _follow(spark, tables, rows, lambda current: merge_silver(current, rows, PAYMENT), applications, batch_id, now)


def delete_payments(
    spark: SparkSession, tables: Followed, keys: DataFrame, applications: DataFrame, *, batch_id, now
) -> None:
    """Take the payments in ``keys`` (payment_id) out; sums and summary follow. Unknown keys
    change nothing."""
    with settled_for_now(spark):
        gone = settle(keys.select(F.col(PAYMENT.key).cast("string")).filter(F.col(PAYMENT.key).isNotNull()).distinct())
        same = {PAYMENT.key: PAYMENT.key}
        _follow(spark, tables, gone, lambda current: delete_hard(current, gone, same), applications, batch_id, now)


def _follow(
    spark: SparkSession,
    tables: Followed,
    keys: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    applications: DataFrame,
    batch_id,
    now,
) -> None:
    """Change payments, then what follows from them. Each change has a batch id of its own,
    greater than those before; with the same one it may run again after a failure.

    The signed rows are written before the payments change, and a batch that has them does not
    make them again: afterwards the payments would show no difference.
    """
    entity = {ENTITY_KEY: hash_key(ENTITY_COLUMNS)}
    deltas = _logged(spark, tables, batch_id)
    if deltas.isEmpty():
        _log(spark, tables, _deltas_of(spark, tables, keys, change).withColumn("batch_id", batch_number(batch_id)))
        deltas = _logged(spark, tables, batch_id)
    merge_into(spark, tables.payments, schemas.PAYMENT, [PAYMENT.key], keys, change, parts=tables.parts)
    merge_into(
        spark,
        tables.sums,
        schemas.PAYMENT_SUMS,
        [ENTITY_KEY],
        deltas,
        lambda sums, laying: fold(sums, deltas, laying),
        parts=tables.parts,
        laid=True,
        given=entity,
    )
    named = settle(deltas.select(*ENTITY_COLUMNS).distinct().select("*", entity[ENTITY_KEY].alias(ENTITY_KEY)), entity)
    touched = parts_of(named, [ENTITY_KEY], tables.parts)
    sums = rows_in(spark, tables.sums, touched)
    # Folding leaves this batch on all sums of what it changed, unless later ones came before.
    kept = sums.filter(F.col("batch_id") == batch_number(batch_id))
    if not sums.filter(F.col("batch_id") > batch_number(batch_id)).isEmpty():
        kept = sums.join(named, ENTITY_KEY, "left_semi")
    found = settle(totals(kept))
    rows = settle_summary(describe(found, applications, moment(now), some=True, batch_id=batch_id, now=now))
    # By the texts that are hashed, which are shorter.
    text = hashed_text(ENTITY_COLUMNS).alias("__text")
    left = named.select(ENTITY_KEY, text).join(small_side(found.select(text)), "__text", "left_anti")
    gone = settle(left.select(ENTITY_KEY))

    def close(current: DataFrame, laying: Laying) -> DataFrame:
        return merge_summary(delete_soft(current, gone, {ENTITY_KEY: ENTITY_KEY}), rows, laying)

    merge_into(
        spark,
        tables.summary,
        schemas.PAYMENT_SUMMARY,
        [ENTITY_KEY],
        named,
        close,
        parts=tables.parts,
        laid=True,
        given=hashes(),
    )


def _deltas_of(
    spark: SparkSession, tables: Followed, keys: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The difference that ``change`` makes, from the rows of its keys alone."""
    named = keys.filter(usable_key(keys, [PAYMENT.key])).select(PAYMENT.key).distinct()
    if is_parted(spark, tables.payments):
        current = rows_in(spark, tables.payments, parts_of(named, [PAYMENT.key], tables.parts))
    else:
        current = read(spark, tables.payments, schemas.PAYMENT).withColumn(PART, F.lit(None).cast("int"))
    before = settle(current.join(small_side(named), PAYMENT.key, "left_semi").select(*current.columns))
    return payment_deltas(before, change(before))


def _logged(spark: SparkSession, tables: Followed, batch_id) -> DataFrame:
    schema = schemas.PAYMENT_SUMS
    return read(spark, tables.deltas, schema).filter(F.col("batch_id") == batch_number(batch_id))


def _log(spark: SparkSession, tables: Followed, deltas: DataFrame) -> None:
    """Add the signed rows of a batch: a partition of its own, which a repeated write replaces."""
    rows = deltas.select(*[c.split()[0] for c in schemas.PAYMENT_SUMS.split(", ")])
    if exists(spark, tables.deltas):
        with dynamic_overwrite(spark):
            rows.write.mode("overwrite").insertInto(tables.deltas)
    else:
        rows.write.format("parquet").option("compression", "zstd").partitionBy("batch_id").saveAsTable(tables.deltas)


def _sums() -> list[Column]:
    return [F.sum(c).cast("decimal(28,2)" if c == "amount" else "long").alias(c) for c in SUMMED]
