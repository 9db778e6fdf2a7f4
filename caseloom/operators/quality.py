"""Quality findings: they are reported, and never stop a run.

Each returns rows ``(check, table, metric, threshold, passed)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import strip
from caseloom.operators.constraints import orphan_counts


def _finding(check: str, table: str, metric: Column, threshold: float) -> Column:
    value = F.coalesce(metric.cast("double"), F.lit(0.0))
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        value.alias("metric"),
        F.lit(float(threshold)).alias("threshold"),
        (value <= threshold).alias("passed"),
    )


def _findings(counts: DataFrame, findings: Sequence[Column]) -> DataFrame:
    return counts.select(F.explode(F.array(*findings)).alias("f")).select("f.*")


def row_drop(before: DataFrame, after: DataFrame, table: str,
             max_percent: float = 20.0) -> DataFrame:
    """Share of rows lost between two layers, in percent; 0 if the first one is empty."""
    n_after = after.agg(F.count(F.lit(1))).scalar()
    counts = before.agg(F.count(F.lit(1)).alias("before")).withColumn("after", n_after)
    lost = F.when(
        F.col("before") > 0, (F.lit(1.0) - F.col("after") / F.col("before")) * 100
    ).otherwise(F.lit(0.0))
    return _findings(counts, [_finding("row drop percent", table, lost, max_percent)])


def unexpected_nulls(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Nulls in columns that always have a default, all counted in one pass."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    return _findings(counts, [_finding(f"nulls in {c}", table, F.col(c), 0) for c in present])


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of each key; null is a key of its own."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    surplus = per_key.agg(F.sum(F.col("n") - 1).alias("n"))
    return _findings(surplus, [_finding(f"duplicate {key}", table, F.col("n"), 0)])


def orphans(df: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose key the parent lacks."""
    missing = orphan_counts(df, key, parent, key).agg(F.sum("n").alias("n"))
    return _findings(missing, [_finding(f"orphan {key}", table, F.col("n"), 0)])


def empty_table(df: DataFrame, table: str) -> DataFrame:
    """1 if the table has no row. Reads at most one row."""
    counts = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _findings(counts, [_finding("empty", table, 1 - F.col("n"), 0)])


def ambiguous_phones(client: DataFrame) -> DataFrame:
    """Primary numbers that several clients share (the lookup takes the smallest profileId)."""
    shared = (
        client.filter(F.col("phoneNumber").isNotNull()).groupBy("phoneNumber")
        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    )
    return _findings(
        shared.agg(F.count(F.lit(1)).alias("n")),
        [_finding("shared phoneNumber", "client", F.col("n"), 0)],
    )


def shared_phones(client: DataFrame) -> DataFrame:
    """Numbers, primary or secondary, that several clients have: each is a tie in the lookup."""
    numbers = client.select("profileId", F.explode(F.array_distinct(
        F.array("phoneNumber", "phoneNumber2"))).alias("number")).filter("number is not null")
    shared = numbers.distinct().groupBy("number").agg(F.count("profileId").alias("n")) \
        .filter(F.col("n") > 1)
    return _findings(shared.agg(F.count(F.lit(1)).alias("n")),
                     [_finding("shared phone number", "client", F.col("n"), 0)])


def lost_values(df: DataFrame, table: str, column: str,
                coerced: Callable[[Column], Column]) -> DataFrame:
    """Values that are not blank and that coercion cannot read."""
    value = F.col(column)
    lost = (F.length(strip(value)) > 0) & coerced(value).isNull()
    return _findings(df.agg(F.count_if(lost).alias("n")),
                     [_finding(f"values lost in {column}", table, F.col("n"), 0)])
