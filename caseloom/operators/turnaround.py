"""Repair of turnaround times against the two dates they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(condition: Column) -> Column:
    """A null condition changes nothing."""
    return F.coalesce(condition, F.lit(False))


def swap_reversed_dates(df: DataFrame, start: str = "logDate", end: str = "resolutionDate",
                        days: str = "turnaroundTime") -> DataFrame:
    """Negative time and dates the wrong way round: swap the dates, recompute the time."""
    a, b, t = F.col(start), F.col(end), F.col(days)
    wrong = _holds((t < 0) & (a > b))
    return df.withColumns({
        start: F.when(wrong, b).otherwise(a),
        end: F.when(wrong, a).otherwise(b),
        days: F.when(wrong, F.datediff(a, b)).otherwise(t),
    })


def recompute_negative(df: DataFrame, start: str = "logDate", end: str = "resolutionDate",
                       days: str = "turnaroundTime") -> DataFrame:
    """Negative time but dates in order: recompute the time."""
    a, b, t = F.col(start), F.col(end), F.col(days)
    return df.withColumn(
        days, F.when(_holds((t < 0) & (b >= a)), F.datediff(b, a)).otherwise(t)
    )


def fill_missing(df: DataFrame, start: str = "logDate", end: str = "resolutionDate",
                 days: str = "turnaroundTime") -> DataFrame:
    """No time but dates in order: compute the time."""
    a, b, t = F.col(start), F.col(end), F.col(days)
    return df.withColumn(
        days, F.when(_holds(t.isNull() & (b >= a)), F.datediff(b, a)).otherwise(t)
    )


def validate_turnaround(df: DataFrame, start: str = "logDate", end: str = "resolutionDate",
                        days: str = "turnaroundTime") -> DataFrame:
    """All repairs: the swap, then the other two on the swapped dates.

    These two exclude each other, so one projection does both.
    """
    a, b, t = F.col(start), F.col(end), F.col(days)
    unusable = _holds((t.isNull() | (t < 0)) & (b >= a))
    return swap_reversed_dates(df, start, end, days).withColumn(
        days, F.when(unusable, F.datediff(b, a)).otherwise(t)
    )
