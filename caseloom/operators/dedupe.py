"""Distinct rows, first rows and blank rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a sheet are numbered below half of this, and from minus half of it.
_ROWS_OF_SHEET = 1 << 45


class LineageOrder:
    """(sheet, row) as one whole number in the same order.

    Aggregates over numbers are hash aggregates, those over texts sort the whole table twice. The
    sheets are listed by a job that reads this one column: a list as long as the source has sheets.
    """

    def __init__(self, df: DataFrame, sheet: str, row: str):
        self.sheet, self.row = sheet, row
        found = [r[0] for r in df.select(sheet).distinct().collect()]
        self.sheets = sorted(s for s in found if s is not None)
        if len(self.sheets) >= (1 << 62) // _ROWS_OF_SHEET:
            raise ValueError("more sheets than lineage numbers can hold")

    def number(self) -> Column:
        """Null sheets come first, null rows first in their sheet."""
        ranks = F.create_map(*[F.lit(x) for pair in zip(self.sheets, range(1, 1 + len(self.sheets)))
                               for x in pair]) if self.sheets else None
        rank = F.lit(0) if ranks is None else F.coalesce(
            F.try_element_at(ranks, F.col(self.sheet)), F.lit(0))
        place = F.coalesce(F.col(self.row).cast("long"), F.lit(-(_ROWS_OF_SHEET // 2)))
        return rank.cast("long") * _ROWS_OF_SHEET + place + _ROWS_OF_SHEET // 2

    def columns(self, number: Column) -> list[Column]:
        """Sheet and row of a number."""
        rank = F.call_function("div", number, F.lit(_ROWS_OF_SHEET)).cast("int")
        sheets = F.array(F.lit(None).cast("string"), *map(F.lit, self.sheets))
        place = number % _ROWS_OF_SHEET - _ROWS_OF_SHEET // 2
        missing = F.lit(-(_ROWS_OF_SHEET // 2))
        return [F.get(sheets, rank).alias(self.sheet), F.nullif(place, missing).alias(self.row)]


def distinct_rows(df: DataFrame, lineage: Sequence[str] = (), having: Column | None = None,
                  listed: DataFrame | None = None) -> DataFrame:
    """Distinct rows over all columns but the lineage (sheet, row), which is that of the first copy.

    Null equals null. Copies combine before the shuffle, however many there are. ``having``
    keeps the distinct rows for which it is true. It is tied to the aggregate's result, so the
    optimiser leaves it there: pushed below projections of many columns, a condition on all of
    them makes its constraint propagation take exponential time. ``listed`` is a frame with the same
    sheets that is cheaper to read.
    """
    business = [c for c in df.columns if c not in lineage]
    order = LineageOrder(df if listed is None else listed, *lineage) if lineage else None
    first = F.min(order.number()) if order else F.count(F.lit(1))
    groups = df.groupBy(*business).agg(first.alias("__first"))
    if having is not None:
        groups = groups.filter(F.when(F.col("__first").isNotNull(), having))
    return groups.select(*business, *(order.columns(F.col("__first")) if order else []))


def first_per_key(df: DataFrame, key: str, lineage: Sequence[str],
                  listed: DataFrame | None = None) -> DataFrame:
    """The first row of each key by its lineage (sheet, row), which no two rows share.

    The first place of each key is found over numbers, rows of a hot key combining in the map
    tasks; then the rows are fetched by place and key, which spreads a hot key's rows evenly and sorts them
    by a number first. ``listed`` is a frame that has all sheets of ``df``, or more, and is cheaper to read.
    """
    order = LineageOrder(df if listed is None else listed, *lineage)
    numbered = df.withColumn("__place", order.number())
    first = numbered.groupBy(F.col(key).alias("__key")).agg(F.min("__place").alias("__first"))
    return numbered.join(
        first, (F.col("__place") == F.col("__first")) & F.col(key).eqNullSafe(F.col("__key")),
        "left_semi",
    ).drop("__place")


def latest_per_key(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Value of the latest row of each key; of rows equally late, the greatest value."""
    return df.groupBy(*keys).agg(
        F.max(F.struct(order, value)).getField(value).alias(value)
    )


def has_value(columns: Sequence[str]) -> Column:
    """True if any of the columns has a value."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()


def drop_blank_rows(df: DataFrame, ignore: Sequence[str]) -> DataFrame:
    """Rows with a value in any column outside ``ignore``."""
    return df.filter(has_value([c for c in df.columns if c not in ignore]))


def drop_unidentified(df: DataFrame, identifiers: Sequence[str]) -> DataFrame:
    """Rows with at least one of the identifiers."""
    return df.filter(F.coalesce(*identifiers).isNotNull())
