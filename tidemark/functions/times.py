"""Run time and batch number as explicit values, so that a rerun gives the same rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_TYPE = "decimal(38,0)"


def moment(value: datetime | str | Column | None) -> Column:
    """A zone-free timestamp column; plain text stands for a literal, not a column name."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("pass a zone-free datetime")
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def batch_number(value: int | str | Decimal | Column | None) -> Column:
    """A batch id column; plain text stands for a literal."""
    if not isinstance(value, Column):
        value = F.lit(None if value is None else str(value))
    return value.cast(BATCH_TYPE)


def batch_id_from(ts: Column) -> Column:
    """All digits of a timestamp, down to nine fraction digits, as one number."""
    return F.date_format(ts, "yyyyMMddHHmmssSSSSSSSSS").cast(BATCH_TYPE)


def iso_text(ts: Column) -> Column:
    """ISO text with a ``T``; the fraction is written only where there is one."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
