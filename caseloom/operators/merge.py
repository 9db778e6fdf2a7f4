"""Merging a source into a keyed target, as plain plans. Sinks are in ``sources``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """All source rows plus the target rows whose key the source lacks. Keys are unique in
    both, so neither side of the join has a hot key; only the key of the source is shuffled."""
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def absent_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows to insert: one per key, and only keys the target lacks."""
    rest = [c for c in source.columns if c not in keys]
    one = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    unique = one.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
    return unique.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the absent source rows added; existing rows stay as they are."""
    return target.unionByName(absent_rows(target, source, keys))
