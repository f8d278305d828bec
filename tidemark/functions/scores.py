"""Result columns of a data-quality check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def failure_ratio(failed: Column, total: Column) -> Column:
    """Failed rows in percent of all rows; 0 for an empty table."""
    share = failed.cast("double") / total.cast("double") * F.lit(100.0)
    return F.when(total > 0, share).otherwise(F.lit(0.0))


def result_status(failed: Column) -> Column:
    return F.when(failed > 0, F.lit("Fail")).otherwise(F.lit("Success"))
