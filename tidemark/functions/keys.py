"""Key expressions: hash keys and the rule for which key values may match."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stored hashes are only comparable while these stay the same.
EMPTY_MARK = "^^"
SEPARATOR = "||"
EMPTY_PAIR = "^^||^^"


def blank_to_null(col: Column | str) -> Column:
    """NULL for an empty string, the value itself otherwise."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(col, F.lit(""))


def hash_key(columns: Sequence[str | Column]) -> Column:
    """SHA-256 hex over the normalised text of the columns.

    Every value is read as text, trimmed and upper-cased; a missing or empty one
    counts as the empty mark. A pair of columns that are both empty gives NULL.
    """
    return F.sha2(hashed_text(columns), 256)


def hashed_text(columns: Sequence[str | Column]) -> Column:
    """The text that ``hash_key`` hashes: equal where the hashes are, and shorter to move."""
    if not columns:
        raise ValueError("hash_key needs at least one column")
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(blank_to_null(F.upper(F.trim(text))), F.lit(EMPTY_MARK)))
    # No part is NULL here, so concat_ws cannot skip one.
    joined = F.concat_ws(SEPARATOR, *parts)
    return F.nullif(joined, F.lit(EMPTY_PAIR))


def usable_key(df: DataFrame, keys: Sequence[str], empty_matches: bool = False) -> Column:
    """True where no key column is NULL (nor an empty string, unless allowed)."""
    tests = []
    for key in keys:
        tests.append(F.col(key).isNotNull())
        if not empty_matches and isinstance(df.schema[key].dataType, T.StringType):
            tests.append(F.col(key) != "")
    return reduce(lambda a, b: a & b, tests)


def packed(col: Column | str, given: Column | None = None) -> Column:
    """A text column as bytes, for a shuffle: hashes in lowercase hex take half their size, any
    other text is kept as it is, and what is equal to ``given``, made of the row's other columns,
    takes nothing. ``unpacked`` with the same ``given`` gives the same text back."""
    col = F.col(col) if isinstance(col, str) else col
    digits = F.concat(F.unhex(F.lit("00")), F.unhex(col))
    whole = F.when(col.rlike("\\A[0-9a-f]{64}\\z"), digits).otherwise(F.concat(F.unhex(F.lit("01")), col.cast("binary")))
    return whole if given is None else F.when(col.eqNullSafe(given), F.unhex(F.lit(""))).otherwise(whole)


def unpacked(col: Column | str, given: Column | None = None) -> Column:
    """The text that was ``packed``."""
    col = F.col(col) if isinstance(col, str) else col
    body = F.substring(col, F.lit(2), F.lit(2**31 - 1))
    text = F.when(F.substring(col, F.lit(1), F.lit(1)) == F.unhex(F.lit("00")), F.lower(F.hex(body))).otherwise(body.cast("string"))
    return text if given is None else F.when(F.length(col) == 0, given).otherwise(text)


def pack(df: DataFrame, given: Mapping[str, Column | None]) -> DataFrame:
    """``df`` with the text columns that ``given`` names ``packed``, each with what it is given by."""
    return _beside_made(df, given, packed)


def unpack(df: DataFrame, given: Mapping[str, Column | None]) -> DataFrame:
    """``df`` with the columns that were packed so ``unpacked``."""
    return _beside_made(df, given, unpacked)


def _beside_made(
    df: DataFrame, given: Mapping[str, Column | None], change: Callable[[str, Column | None], Column]
) -> DataFrame:
    # Made in a step of its own: within a condition Spark repeats a hash's texts for each of their
    # uses, and such code is too long for the JVM to compile.
    made = {c: f"__made_{c}" for c, g in given.items() if g is not None}
    if made:
        df = df.withColumns({m: given[c] for c, m in made.items()})
    changed = df.withColumns({c: change(c, F.col(made[c]) if c in made else None) for c in given})
    return changed.drop(*made.values())
