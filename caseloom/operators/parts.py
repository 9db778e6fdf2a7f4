"""Merging into tables stored in parts: only the parts that change are read and written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.merge import upsert
from caseloom.sources.store import PART, TableStore


def key_part(key: Column, parts: int) -> Column:
    """Name of the part that a key falls into, of ``parts`` about equal ones."""
    leading = F.conv(F.substring(F.md5(F.encode(key, "utf-8")), 1, 8), 16, 10).cast("long")
    return F.lpad((leading % parts).cast("string"), 6, "0")


def upsert_parts(store: TableStore, table: str, source: DataFrame, key: str,
                 parts: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """An upsert that rewrites only the parts that source keys fall into.

    Returns the new rows of these parts, with the column that names them, all rows of the table
    after the merge, and the parts. ``store.replace(parts=...)`` then commits them: the files of all
    other parts stay as they are and are not read. ``parts`` must stay what it was when the table
    was first written.
    """
    source = source.withColumn(PART, key_part(F.col(key), parts))
    touched = sorted(r[0] for r in source.select(PART).distinct().collect())
    if not store.exists(table):
        return source, source.drop(PART), touched
    target = store.read(table, touched).withColumn(PART, key_part(F.col(key), parts))
    merged = upsert(target, source, key)
    rest = set(store.parts(table)) - set(touched)
    return merged, merged.drop(PART).unionByName(store.read(table, rest)), touched
