"""Delete capture from a change log, and hard or soft deletes on a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import table_for_view
from tidemark.functions.times import batch_number, moment
from tidemark.operators.bands import Within, in_levels
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import merge
from tidemark.operators.sizing import fits_broadcast, small_side
from tidemark.sources.tables import settle

# Fixed value: the event type that marks a delete in the change archive.
DELETE_EVENT = "IncrementalDeleteRows"

#: Bits of a bitmap of Spark's, and of all bitmaps that stand for delete keys.
BUCKET = 32768
MOST_BITS = 1 << 27


def capture_deletes(
    changes: DataFrame,
    log: DataFrame,
    *,
    model_id: Column,
    model_grp: Column,
    pipeline_name: Column,
    batch_id,
    now,
    latest_event: bool = False,
) -> DataFrame:
    """The delete log with the latest delete event of each key merged in.

    With ``latest_event``, a key counts as deleted only if no other event of it came later.

    ``changes`` has primary_key__pk, seen_at, least_significant_position and event_type;
    the naming columns may be literals (one model) or columns of it (many models at once).
    A key that is in the log already keeps its first load time and batch.
    """
    is_delete = F.col("event_type") == DELETE_EVENT
    events = (changes if latest_event else changes.filter(is_delete)).select(
        model_id.alias("model_id"),
        model_grp.alias("model_grp"),
        pipeline_name.alias("pipeline_name"),
        F.col("primary_key__pk").cast("string").alias("pk"),
        moment(F.col("seen_at")).alias("src_load_ts"),
        "least_significant_position",
        is_delete.alias("__deleted"),
    )
    latest = latest_per_key(
        events,
        ["model_id", "pk"],
        [F.desc("src_load_ts"), F.desc("least_significant_position")],
    ).filter("__deleted")
    rows = settle(latest.drop("least_significant_position", "__deleted")).withColumns(
        {
            "batch_id": batch_number(batch_id),
            "etl_load_ts": moment(now),
            "etl_updt_ts": moment(now),
        }
    )
    return merge(
        log,
        rows,
        ["model_id", "pk"],
        update=["model_grp", "pipeline_name", "etl_updt_ts"],
        empty_matches=True,
        duplicates="trust",
    )


def logged_keys(log: DataFrame, model_id: str, target: DataFrame, key: str) -> DataFrame:
    """Distinct logged keys of a model, in the type of the table's key column.

    The model name is compared without case, and a view name stands for its table.
    """
    table = F.upper(table_for_view(F.lit(model_id)))
    return (
        log.filter(F.upper("model_id") == table)
        .select(F.col("pk").try_cast(target.schema[key].dataType).alias(key))
        .filter(F.col(key).isNotNull())
        .distinct()
    )


def count_deletes(target: DataFrame, log: DataFrame, model_id: str, key: str) -> DataFrame:
    """How many rows of the table the log would delete, as one row."""
    keys = settle(logged_keys(log, model_id, target, key))
    hits = target.select(key).join(keys, key, "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("deleted_count"))


def delete_hard_logged(target: DataFrame, log: DataFrame, model_id: str, key: str) -> DataFrame:
    """The table without the rows whose key is logged as deleted for the model."""
    return delete_hard(target, logged_keys(log, model_id, target, key), {key: key})


def delete_soft_logged(target: DataFrame, log: DataFrame, model_id: str, key: str) -> DataFrame:
    """Close the active rows whose key is logged as deleted for the model."""
    return delete_soft(target, logged_keys(log, model_id, target, key), {key: key})


def delete_hard(
    target: DataFrame,
    deletes: DataFrame,
    keys: Mapping[str, str],
    condition: Column | None = None,
    *,
    within: Within | None = None,
) -> DataFrame:
    """The table without the rows that have a match in ``deletes``.

    ``keys`` maps table columns to delete columns; ``condition`` is any further test over the
    aliases ``t`` (table) and ``s`` (deletes). Without keys, ``within`` must name a value that
    lies in a range: Spark can hash its bins, see ``bands``. With neither it would compare
    every pair, which is refused.
    """
    condition = _checked(keys, condition, within)
    if not keys:
        kept, levels = in_levels(target, settle(deletes.distinct()), within, condition)
        for ranges, test in levels:
            kept = kept.alias("t").join(ranges.alias("s"), test, "left_anti").select("t.*")
        return kept.select(*target.columns)
    deletes = _distinct(deletes, keys, condition)

    def drop(rows: DataFrame) -> DataFrame:
        kept = rows.alias("t").join(small_side(deletes).alias("s"), _match(keys, condition), "left_anti")
        return kept.select(*target.columns)

    if condition is None and not fits_broadcast(deletes):
        return _around_null_keys(target, keys, lambda rows: _around_sure(rows, deletes, keys, drop))
    return _around_null_keys(target, keys, drop)


def delete_soft(
    target: DataFrame,
    deletes: DataFrame,
    keys: Mapping[str, str],
    condition: Column | None = None,
    *,
    within: Within | None = None,
) -> DataFrame:
    """Close the active rows that have a match in ``deletes``: inactive, ended at the
    time of their last update. The reporting flag stays. Arguments as in ``delete_hard``."""
    active = F.coalesce(F.col("t.active_flg") == "Y", F.lit(False))
    condition = _checked(keys, condition, within)

    def marked(rows: DataFrame, old: DataFrame, test: Column) -> DataFrame:
        """A row may match many deletes: its mark is one existence test in one join."""
        hit = old.alias("s").where(test.outer()).exists()
        return rows.alias("t").select("t.*", hit.alias("__now")).withColumn(
            "__hit", F.col("__hit") | F.col("__now")
        ).drop("__now")

    if not keys:
        rows, levels = in_levels(target, settle(deletes.distinct()), within, condition)
        rows = rows.withColumn("__hit", F.lit(False))
        for ranges, test in levels:
            rows = marked(rows, ranges, test)
        return rows.alias("t").select(*_closed(target, active & F.col("__hit")))
    deletes = _distinct(deletes, keys, condition)
    once = condition is None and all(target.schema[t].dataType == deletes.schema[s].dataType for t, s in keys.items())

    def close(rows: DataFrame) -> DataFrame:
        if once:
            # A row matches one delete at most. Later filters on the flags do not repeat this
            # join below themselves, as they do an existence test.
            there = small_side(deletes).withColumn("__there", F.lit(True)).alias("s")
            found = rows.alias("t").join(there, _match(keys, None), "left")
            hit = F.coalesce(F.col("s.__there"), F.lit(False))
            return found.select(*_closed(target, active & hit))
        found = marked(rows.withColumn("__hit", F.lit(False)), small_side(deletes), _match(keys, condition))
        return found.alias("t").select(*_closed(target, active & F.col("__hit")))

    if once and not fits_broadcast(deletes):
        return _around_null_keys(target, keys, lambda rows: _around_sure(rows, deletes, keys, close))
    return _around_null_keys(target, keys, close)


def _checked(keys: Mapping[str, str], condition: Column | None, within: Within | None) -> Column | None:
    """The condition beside the keys, or beside the bins of a range."""
    if not keys and within is None:
        raise ValueError("a delete needs a key equality or a range")
    if within is None or not keys:
        return condition
    return within.test() if condition is None else within.test() & condition


def _around_sure(
    rows: DataFrame,
    deletes: DataFrame,
    keys: Mapping[str, str],
    step: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``step`` for the rows that may have a match; the others stay where they are.

    For delete keys that are too many to broadcast themselves. Each sets a bit at its hash; a
    row whose bit is not set has surely no match, and does not enter the shuffle. The bits take
    16 times as many as there are keys, which leaves one row in sixteen to the exact join;
    there are at most MOST_BITS, 16 MB, and none are made where those would be too few.
    """
    count = deletes.count()
    bits = max(BUCKET, 1 << (16 * count - 1).bit_length())
    if bits > MOST_BITS:
        return step(rows)

    def place(columns: Sequence[str], types: DataFrame) -> Column:
        # The same types on both sides, so that equal keys hash alike.
        named = [F.col(c).cast(types.schema[t].dataType) for c, t in zip(columns, keys)]
        return F.pmod(F.xxhash64(*named), F.lit(bits))

    at = deletes.select(place(list(keys.values()), rows).alias("at"))
    bitmaps = settle(
        at.groupBy(F.floor(F.col("at") / BUCKET).alias("__bucket")).agg(
            F.bitmap_construct_agg((F.col("at") % BUCKET).cast("long")).alias("__bits")
        )
    )
    placed = rows.withColumn("__at", place(list(keys), rows))
    placed = placed.withColumn("__bucket", F.floor(F.col("__at") / BUCKET))
    byte = F.substring("__bits", ((F.col("__at") % BUCKET) / 8).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    bit = F.call_function("shiftright", number, (F.col("__at") % 8).cast("int")).bitwiseAND(F.lit(1))
    tested = placed.join(F.broadcast(bitmaps), "__bucket", "left").withColumn(  # MOST_BITS at most
        "__maybe", F.coalesce(bit == 1, F.lit(False))
    )
    sure = tested.filter(~F.col("__maybe")).select(*rows.columns)
    return sure.unionByName(step(tested.filter("__maybe").select(*rows.columns)))


def _closed(target: DataFrame, hit: Column) -> list[Column]:
    new = {"active_flg": F.lit("N"), "end_ts": F.col("t.etl_updt_ts")}
    return [
        F.when(hit, new[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in new else F.col(f"t.{c}")
        for c in target.columns
    ]


def _match(keys: Mapping[str, str], condition: Column | None) -> Column:
    tests = [F.col(f"t.{t}") == F.col(f"s.{s}") for t, s in keys.items()]
    if condition is not None:
        tests.append(condition)
    return reduce(lambda a, b: a & b, tests)


def _distinct(deletes: DataFrame, keys: Mapping[str, str], condition: Column | None) -> DataFrame:
    if condition is None:
        deletes = deletes.select(*keys.values())
    # Folded map-side: a key deleted over and over moves once per task. Settled: its size
    # is known before Spark decides whether the table has to be shuffled.
    return settle(deletes.distinct())


def _around_null_keys(
    target: DataFrame,
    keys: Mapping[str, str],
    step: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply ``step``; rows with a NULL key go around it, because they match nothing and
    would all meet in one task of a shuffle."""
    if not any(target.schema[k].nullable for k in keys):
        return step(target)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return step(target.filter(keyed)).unionByName(target.filter(~keyed))
