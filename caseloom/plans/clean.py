"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.coerce import DATE_FORMATS, to_calendar_date, to_int
from caseloom.functions.phone import e164
from caseloom.functions.text import default_name, lower_camel, strip, title_case
from caseloom.operators.canonical import canonicalise
from caseloom.operators.dedupe import distinct_rows, has_value
from caseloom.operators.turnaround import validate_turnaround
from caseloom.plans.schema import (
    ALWAYS_FILLED, CASE_KEPT, DATE_COLUMNS, LINEAGE, REGION_THRESHOLD, REGIONS, RENAMES,
)


def rename_headers(df: DataFrame, lineage: Sequence[str] = LINEAGE) -> DataFrame:
    """Sheet headers to lower camel case, then the known short forms to their long names."""
    names = {c: c if c in lineage else lower_camel(c) for c in df.columns}
    return df.withColumnsRenamed({c: RENAMES.get(n, n) for c, n in names.items()})


def standardise_values(df: DataFrame, lineage: Sequence[str] = LINEAGE,
                       case_kept: Sequence[str] = CASE_KEPT,
                       date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Row-wise cleaning of a frame with standard headers.

    Two projections: the second uses its inputs more than once, so what they cost is paid in
    the first. Columns that are absent are skipped; those typed already only pass through.
    """
    text = {
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in lineage
    }

    def trimmed(name: str) -> Column:
        value = F.col(name)
        if name not in text:
            return value
        if name == "name":
            return default_name(value)
        if name == "turnaroundTime":
            return to_int(value)
        if name in DATE_COLUMNS:
            return to_calendar_date(value, date_formats)
        return e164(value) if name == "number" else strip(value)

    titled = text - {"turnaroundTime", *DATE_COLUMNS, *case_kept}
    return df.select(*[trimmed(c).alias(c) for c in df.columns]).select(
        *[title_case(F.col(c)).alias(c) if c in titled else F.col(c) for c in df.columns]
    )


def clean_values(df: DataFrame, lineage: Sequence[str] = LINEAGE,
                 regions: Sequence[str] = REGIONS,
                 threshold: float = REGION_THRESHOLD) -> DataFrame:
    """Headers, values and regions; as many rows as before."""
    df = standardise_values(rename_headers(df, lineage), lineage)
    return canonicalise(df, "region", regions, threshold) if "region" in df.columns else df


def clean(df: DataFrame, lineage: Sequence[str] = LINEAGE) -> DataFrame:
    """Cleaned rows, distinct across all sheets."""
    rows = clean_values(df, lineage)
    return distinct_rows(rows, [c for c in lineage if c in rows.columns], listed=df)


def meaningful_rows(df: DataFrame, lineage: Sequence[str] = LINEAGE) -> DataFrame:
    """Cleaned distinct rows that hold more than defaults."""
    rows = clean_values(df, lineage)
    telling = [c for c in rows.columns if c not in (*ALWAYS_FILLED, *lineage)]
    return distinct_rows(rows, [c for c in lineage if c in rows.columns], has_value(telling), df)


def to_silver(bronze: DataFrame, lineage: Sequence[str] = LINEAGE) -> DataFrame:
    """Cleaned, non-blank rows with repaired turnaround times."""
    return validate_turnaround(meaningful_rows(bronze, lineage))
