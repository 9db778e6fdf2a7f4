"""Mapping free-text values onto a short reference list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.similarity import best_choice, exact_choice
from caseloom.functions.text import strip
from caseloom.operators.joins import is_broadcastable, lookup_join
from caseloom.session import scratch_path


def score_variants(values: DataFrame, column: str, choices: Sequence[str],
                   threshold: float) -> DataFrame:
    """(column, __choice): distinct values that are no reference entry, scored once each.

    The condition is tied to the aggregate's result, so the optimiser leaves it there: pushed below the
    projections that clean the column, it would repeat their expressions for every row, once for each use.
    """
    distinct = values.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    telling = (F.length(strip(F.col(column))) > 0) & ~F.col(column).isin(list(choices))
    variants = distinct.filter(F.when(F.col("__n") > 0, telling))
    return variants.select(column).withColumn(
        "__choice", best_choice(F.col(column), choices, threshold)["choice"]
    )


def canonicalise(df: DataFrame, column: str, choices: Sequence[str], threshold: float = 80.0,
                 default: str = "Unknown", slice_rows: int | None = None) -> DataFrame:
    """Replace each value by the most similar reference entry, or by the default.

    Reference entries resolve by a constant map, without a join. All other distinct values
    are scored once and written to the shared folder; the size of that table decides how it
    joins back: broadcast if small, else by a shuffle that slices hot values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "variants")
    scored = score_variants(df, column, choices, threshold)
    scored.write.parquet(path)
    lookup = spark.read.schema(scored.schema).parquet(path)

    entries = F.create_map(*[F.lit(x) for pair in exact_choice(choices).items() for x in pair])
    value = F.col(column)
    is_entry = F.coalesce(value.isin(list(choices)), F.lit(False))
    # Entries and blanks need no lookup. They get a null key, and those join nothing.
    variant = F.when(~is_entry & (F.length(strip(value)) > 0), value).alias("__variant")
    keyed = df.select("*", variant)
    lookup = lookup.withColumnRenamed(column, "__variant")
    if is_broadcastable(lookup):
        joined = keyed.join(F.broadcast(lookup), "__variant", "left")
    else:  # only the rows that need it are moved
        rest = keyed.filter(F.col("__variant").isNull())
        joined = lookup_join(keyed.filter(F.col("__variant").isNotNull()), lookup, "__variant",
                             "left", slice_rows).unionByName(rest, allowMissingColumns=True)
    resolved = F.coalesce(
        F.when(is_entry, F.try_element_at(entries, value)), F.col("__choice"), F.lit(default)
    )
    return joined.select(*[resolved.alias(c) if c == column else c for c in df.columns])
