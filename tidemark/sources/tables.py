"""Catalog tables whose states are written whole, each behind the view of the table's name.

For ledgers, logs and other small tables: a new state is a new table, and the view is switched
to it, so readers see either state and a plan built before keeps reading the one it was planned
on. Large tables are kept in partitions by key, see ``parted``.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import pack, unpack

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")
# What a version adds to its table's name: nanoseconds and a random part.
_VERSION = r"__\d{20}_[0-9a-f]{8}"


class StateChanged(RuntimeError):
    """Another writer has published a table since the state that a plan was made on."""


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(checked_name(name))


def read(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """The table's current state; an empty frame of ``schema`` before its first write."""
    if schema is not None and not exists(spark, name):
        return empty(spark, schema)
    return spark.table(checked_name(name))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of ``schema``, as a plan that Spark knows to be empty."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    ).filter(F.lit(False))


def state(spark: SparkSession, name: str) -> str:
    """What names a table's current state; empty before the first write."""
    return _view_text(spark, name) if exists(spark, name) else ""


def publish(
    df: DataFrame,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    based_on: str | None = None,
) -> DataFrame:
    """Write ``df`` as the table's new state and switch to it.

    ``bucket_by`` lays rows out by key, one file a bucket: later merges on that key need no
    shuffle of the table. ``partition_by`` suits flags and batch ids, which readers filter on.
    ``based_on`` is the ``state`` that ``df`` was made from: when another writer has published
    since, nothing is switched and StateChanged is raised.
    """
    written = _write(df, name, partition_by, bucket_by, buckets)
    if based_on is not None and state(df.sparkSession, name) != based_on:
        raise StateChanged(f"{name} was published by another writer")
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {_columns(df)} FROM {written}")
    return df.sparkSession.table(name)


def update(
    spark: SparkSession,
    name: str,
    schema: str,
    change: Callable[[DataFrame], DataFrame],
    attempts: int = 5,
) -> DataFrame:
    """Publish ``change`` of the current state; when another writer was faster, of its state.

    For tables that pipelines share, such as a ledger. The last look at the state and the
    switch are two steps of the catalog: writers within that moment are not told apart.
    """
    for left in reversed(range(attempts)):
        before = state(spark, name)
        try:
            return publish(change(read(spark, name, schema)), name, based_on=before)
        except StateChanged:
            if not left:
                raise
    raise ValueError("attempts counts at least one")


def current_version(spark: SparkSession, name: str) -> str:
    """The written version that the table's current state reads."""
    return re.search(rf"{re.escape(checked_name(name))}{_VERSION}\b", _view_text(spark, name)).group()


def versions(spark: SparkSession, name: str) -> list[str]:
    """The written versions of a table, oldest first."""
    database, _, table = checked_name(name).rpartition(".")
    found = spark.catalog.listTables(database or None, f"{table}__*")
    prefix = f"{database}." if database else ""
    ours = re.compile(re.escape(table) + _VERSION, re.IGNORECASE)
    return sorted(
        f"{prefix}{t.name}" for t in found if t.tableType != "VIEW" and ours.fullmatch(t.name)
    )


def prune(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Drop versions but the current state's and the newest ``keep``; a plan that was made
    on a dropped one fails."""
    if keep < 0:
        raise ValueError("keep counts versions")
    current = current_version(spark, name)
    written = versions(spark, name)
    for version in written[: max(0, len(written) - keep)]:
        if version != current:
            spark.sql(f"DROP TABLE {version}")


def drop(spark: SparkSession, name: str) -> None:
    """Drop a table with all its versions, or with its partitions."""
    if exists(spark, name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")
    spark.sql(f"DROP TABLE IF EXISTS {checked_name(name)}__rows")
    for version in versions(spark, name):
        spark.sql(f"DROP TABLE {version}")


def append(df: DataFrame, folder: str) -> None:
    """Add rows to a parquet folder."""
    df.write.mode("append").parquet(folder)


def replace_partitions(df: DataFrame, folder: str, partition_by: Sequence[str]) -> None:
    """Rewrite just the partitions that ``df`` holds; a rerun of a batch is idempotent."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(folder)
    )


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder the cluster names for checkpoints, else
    the warehouse.

    The named folder is taken as it is: a file path may well be a mount that all executors
    share. The warehouse of default settings is a machine's own disk, which a cluster must
    not use: there a checkpoint folder has to be named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = re.match(r"file:|/|[^:/]*$|[^:]*/", warehouse) is not None
    if own_disk and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


_scope: ContextVar[str | None] = ContextVar("settled", default=None)


@contextmanager
def settled_for_now(spark: SparkSession) -> Iterator[None]:
    """Within this, what ``settle`` writes is for this step alone and goes at its end: for
    steps that publish their result, after which nothing reads the settled frames."""
    if _scope.get() is not None:  # part of a larger step
        yield
        return
    with settled_apart(spark) as folder:
        try:
            yield
        finally:
            forget_settled(spark, folder)


@contextmanager
def settled_apart(spark: SparkSession) -> Iterator[str]:
    """Within this, ``settle`` writes to a folder of its own, which is given: for a step whose
    result is read later. ``forget_settled`` deletes it when that has been done."""
    folder = f"{_settled_folder(spark)}/step-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)


def forget_settled(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, given: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For an increment that several branches of a plan use: it is computed once, survives
    lost executors, and has a measured size for Spark's join choice. All settled frames of
    an application share a folder, which may go when the application has ended; those of a
    step that publishes go with it, see ``settled_for_now``.

    Text columns in ``given`` are made again when they are read, where a row's other columns
    give them so; a value that differs is written.
    """
    spark = df.sparkSession
    folder = f"{_scope.get() or _settled_folder(spark)}/{uuid.uuid4().hex}"
    given = given or {}
    lean = pack(df, given) if given else df
    lean.write.option("compression", "zstd").parquet(folder)
    written = spark.read.schema(lean.schema).parquet(folder)
    return unpack(written, given) if given else written


def _settled_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.conf.get('spark.app.id', 'session')}"


def _write(
    df: DataFrame, name: str, partition_by: Sequence[str], bucket_by: Sequence[str], buckets: int
) -> str:
    # Names sort by age; the random part keeps two writers apart.
    version = f"{checked_name(name)}__{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        # One task a bucket, so one file; else every task would add its own to each.
        writer = df.repartition(buckets, *bucket_by).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(version)
    return version


def _view_text(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {checked_name(name)}")
    return described.filter(F.col("col_name") == "View Text").first()["data_type"]


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{c}`" for c in df.columns)


def checked_name(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name
