"""Counts that are kept up by signed changes.

A table of counts has a row per group with additive measures. Inserted rows are counted and added, removed
ones counted and taken off; an update is both. Groups that nothing is left of go, so what is derived from
the groups, such as a number of different values, an average or a most frequent value, is right after
removals as well, and the rows that did not change are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Counted = Callable[[DataFrame], DataFrame]


def signed(counts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The counts with all measures negated."""
    return counts.select(*[(-F.col(c)).alias(c) if c in measures else F.col(c) for c in counts.columns])


def apply_changes(counts: DataFrame | None, counted: Counted, inserted: DataFrame | None,
                  removed: DataFrame | None, measures: Sequence[str], rows: str = "n") -> DataFrame:
    """Counts after the changes. ``rows`` is the measure that is zero where a group has no rows.

    More rows removed from a group than it has are an error, found when the result is read.
    """
    changes = [] if counts is None else [counts]
    changes += [] if inserted is None else [counted(inserted)]
    changes += [] if removed is None else [signed(counted(removed), measures)]
    total = changes[0]
    for change in changes[1:]:
        total = total.unionByName(change)
    groups = [c for c in total.columns if c not in measures]
    summed = total.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in measures])
    checked = F.when(F.col(rows) < 0, F.raise_error(F.lit("more rows removed than there were"))
                     .cast("long")).otherwise(F.col(rows))
    return summed.withColumn(rows, checked).filter(F.col(rows) != 0)
