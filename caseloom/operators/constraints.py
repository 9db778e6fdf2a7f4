"""Declared constraints, checked as Spark jobs before a load writes anything.

Each check is one aggregation that combines before its shuffle and returns rows
``(table, rule, columns, violations)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    max_length: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    references: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


class ConstraintViolation(ValueError):
    """A table breaks its declared constraints; nothing has been written."""


def _long_form(counts: DataFrame, table: str,
               entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counts -> one row per (count column, rule, checked columns)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(rule).alias("rule"),
                F.lit(checked).alias("columns"),
                F.coalesce(F.col(f"`{count}`"), F.lit(0)).cast("long").alias("violations"),
            )
            for count, rule, checked in entries
        ]
    )
    return counts.select(F.explode(rows).alias("e")).select("e.*")


def column_violations(df: DataFrame, table: Table,
                      rules: Sequence[str] = ("not null", "length")) -> DataFrame:
    """Not-null and length checks of all columns in a single pass over the table."""
    present = [c for c in table.columns if c.name in df.columns]
    checks = {}
    if "not null" in rules:
        for c in present:
            if not c.nullable:
                checks[f"null {c.name}", "not null", c.name] = F.col(c.name).isNull()
    if "length" in rules:
        for c in present:
            if c.max_length:
                checks[f"long {c.name}", "length", c.name] = F.length(c.name) > c.max_length
    counts = df.agg(*[F.count_if(broken).alias(name) for (name, _, _), broken in checks.items()])
    return _long_form(counts, table.name, list(checks))


def unique_violations(df: DataFrame, table: Table) -> DataFrame:
    """Rows beyond the first of each key. Nulls in a key never collide."""

    def surplus(key: tuple[str, ...]) -> DataFrame:
        groups = (
            df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1)
        )
        name = ", ".join(key)
        return _long_form(
            groups.agg(F.sum(F.col("n") - 1).alias("n")), table.name, [("n", "unique", name)]
        )

    return reduce(DataFrame.unionByName, [surplus(key) for key in table.unique])


def orphan_counts(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, n): rows per key value the parent lacks, null included. Rows are counted per key
    first, so the join sees one row per key however hot a key is."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(key))
    return counts.join(known, key, "left_anti")


def foreign_key_violations(df: DataFrame, table: Table,
                           parents: dict[str, DataFrame]) -> DataFrame:
    def dangling(fk: ForeignKey) -> DataFrame:
        referring = df.filter(F.col(fk.column).isNotNull())
        orphans = orphan_counts(referring, fk.column, parents[fk.table], fk.references)
        return _long_form(
            orphans.agg(F.sum("n").alias("n")), table.name, [("n", "foreign key", fk.column)]
        )

    return reduce(DataFrame.unionByName, [dangling(fk) for fk in table.foreign_keys])


def violations(df: DataFrame, table: Table, parents: dict[str, DataFrame]) -> DataFrame:
    """All checks of one table."""
    report = column_violations(df, table)
    if table.unique:
        report = report.unionByName(unique_violations(df, table))
    if table.foreign_keys:
        report = report.unionByName(foreign_key_violations(df, table, parents))
    return report


def require_valid(tables: Sequence[tuple[DataFrame, Table]],
                  parents: dict[str, DataFrame]) -> None:
    """Raise if any table breaks a constraint. One job; a row per rule comes back."""
    report = reduce(
        DataFrame.unionByName, [violations(df, table, parents) for df, table in tables]
    )
    broken = report.filter(F.col("violations") > 0).collect()
    if broken:
        raise ConstraintViolation(
            "; ".join(
                f"{r['table']}.{r['columns']}: {r['violations']} rows break {r['rule']}"
                for r in broken
            )
        )
