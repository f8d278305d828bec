"""Keyed merge of an increment into a table, as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import usable_key
from tidemark.operators.latest import assert_one_per_key, latest_per_key
from tidemark.operators.sizing import fits_broadcast

DUPLICATE_POLICIES = ("error", "latest", "trust")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str] | None,
    *,
    exclude: Sequence[str] = (),
    update: Sequence[str] | None = None,
    expressions: Mapping[str, Column] | None = None,
    guard: str | None = None,
    empty_matches: bool = False,
    duplicates: str = "error",
    order_by: Sequence[str | Column] = (),
    small_source: bool | None = None,
) -> DataFrame:
    """Update matched target rows from ``source`` and add the other source rows.

    keys            matched on equality; NULL never matches, nor does an empty string
                    unless ``empty_matches``. No keys: all source rows are added.
    exclude         columns (any case) that keep the target's value on a match.
    update          the only columns to change on a match (default: all but ``exclude``).
    expressions     column -> value on a match, over the aliases ``old`` and ``new``;
                    replaces ``update``.
    guard           flag column: only target rows with 'Y' there can match.
    duplicates      source rows sharing a key: ``error``, ``latest`` (first in
                    ``order_by``), or ``trust`` when the caller has made them unique.
    small_source    override the size check that chooses between the two joins.

    A small increment is broadcast against the streamed table; a larger one meets it in one
    full outer join. Rows without a usable key, and those the guard keeps out, skip the join.
    """
    if duplicates not in DUPLICATE_POLICIES:
        raise ValueError(f"duplicates must be one of {DUPLICATE_POLICIES}")
    columns = target.columns
    source = conform(source, target)
    keys = _named(target, [keys] if isinstance(keys, str) else list(keys or []))
    if not keys:
        return target.unionByName(source, allowMissingColumns=True)

    usable = usable_key(source, keys, empty_matches)
    keyless, keyed = source.filter(~usable), source.filter(usable)
    if duplicates == "latest":
        if not order_by:
            raise ValueError("duplicates='latest' needs order_by")
        keyed = latest_per_key(keyed, keys, order_by)
    elif duplicates == "error":
        keyed = assert_one_per_key(keyed, keys)

    if expressions is None:
        held = {c.lower() for c in exclude}
        named = columns if update is None else _named(target, update)
        expressions = {
            c: F.col(f"new.{c}")
            for c in named
            if c.lower() not in held and c in keyed.columns
        }

    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    # Rows that cannot match go around the join, whatever plan Spark makes of it: their NULL
    # keys, or the closed versions of one key, would all meet in one task.
    matchable = usable_key(target, keys, empty_matches)
    if guard is not None:
        matchable = matchable & F.coalesce(F.col(guard) == "Y", F.lit(False))
    always = empty_matches and guard is None and not any(target.schema[k].nullable for k in keys)
    joinable = target if always else target.filter(matchable)
    around = None if always else target.filter(~matchable)

    def on_match(c: str) -> Column:
        return expressions.get(c, F.col(f"old.{c}"))

    hit, present = F.col("new.__hit"), F.col("old.__old")
    marked = keyed.withColumn("__hit", F.lit(True)).alias("new")
    matches = reduce(lambda a, b: a & b, on)
    small = fits_broadcast(source) if small_source is None else small_source
    if small:
        # The increment is broadcast: the table is not shuffled, nor are its keys.
        joined = joinable.alias("old").join(marked, matches, "left")
        merged = joined.select(*[F.when(hit, on_match(c)).otherwise(F.col(f"old.{c}")).alias(c) for c in columns])
        known = joinable.select(*keys).join(source.filter(usable).select(*keys), keys, "left_semi")
        # The distinct folds a repeated key map-side, before it moves.
        added = keyed.join(known.distinct(), keys, "left_anti")
        merged = merged.unionByName(added, allowMissingColumns=True)
    else:
        # Both sides move once, the table not at all when it is bucketed by the key.
        old = joinable.withColumn("__old", F.lit(True)).alias("old")
        joined = old.join(marked, matches, "full_outer")

        def value(c: str) -> Column:
            new = F.col(f"new.{c}") if c in keyed.columns else F.lit(None).cast(target.schema[c].dataType)
            kept = F.when(hit, on_match(c)).otherwise(F.col(f"old.{c}"))
            return F.when(present, kept).otherwise(new).alias(c)

        merged = joined.select(*[value(c) for c in columns])
    if around is not None:
        merged = merged.unionByName(around)
    return merged.unionByName(keyless, allowMissingColumns=True)


def _named(target: DataFrame, names: Sequence[str]) -> list[str]:
    """The target's own spelling of column names."""
    spelled = {c.lower(): c for c in target.columns}
    unknown = [n for n in names if n.lower() not in spelled]
    if unknown:
        raise ValueError(f"not in the target: {unknown}")
    return [spelled[n.lower()] for n in names]


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source's columns that the target has, in the target's order and types."""
    offered = {c.lower(): c for c in source.columns}
    chosen = []
    for field in target.schema.fields:
        name = offered.get(field.name.lower())
        if name is None:
            continue
        column = F.col(name)
        if source.schema[name].dataType != field.dataType:
            column = column.cast(field.dataType)
        chosen.append(column.alias(field.name))
    return source.select(*chosen)
