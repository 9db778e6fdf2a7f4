"""Change detection by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.dedupe import latest_per_key

_HEX_PER_LANE = 15
_LANES = 4


def sheet_fingerprints(df: DataFrame, sheet: str = "sheet", position: str = "row_idx") -> DataFrame:
    """(sheet, content_hash, row_count): equal exactly when sheets hold the same rows in the
    same order.

    Each row is written as ``name:length=value`` parts in column-name order, nulls left out,
    after its position, and hashed with SHA-256. Rows combine by exclusive or of four 60-bit
    lanes: positions make rows differ, so equal rows do not cancel out, and partial results
    of a sheet's tasks merge in any order.
    """
    values = [c for c in sorted(df.columns) if c not in (sheet, position)]
    parts = [
        F.concat(
            F.lit(f"{c}:"), F.length(F.col(f"`{c}`")).cast("string"), F.lit("="), F.col(f"`{c}`")
        )
        for c in values
    ]
    row_hash = F.sha2(F.concat_ws("|", F.col(position).cast("string"), *parts), 256)
    hashed = df.select(sheet, row_hash.alias("h"))
    lanes = [
        F.bit_xor(
            F.conv(F.substring("h", 1 + i * _HEX_PER_LANE, _HEX_PER_LANE), 16, 10).cast("long")
        ).alias(f"x{i}")
        for i in range(_LANES)
    ]
    combined = hashed.groupBy(sheet).agg(*lanes, F.count(F.lit(1)).alias("row_count"))
    digest = F.sha2(
        F.concat_ws(
            ":", F.col("row_count").cast("string"),
            *[F.col(f"x{i}").cast("string") for i in range(_LANES)],
        ),
        256,
    )
    return combined.select(sheet, digest.alias("content_hash"), "row_count")


def last_known_hash(log: DataFrame, keys: Sequence[str] = ("sheet_name", "source_file"),
                    value: str = "content_hash", order: str = "processed_at") -> DataFrame:
    """Latest logged fingerprint of each (sheet, file)."""
    return latest_per_key(log, keys, value, order)


def changed_sheets(current: DataFrame, last: DataFrame,
                   keys: Sequence[str] = ("sheet_name", "source_file")) -> DataFrame:
    """Sheets whose fingerprint differs from the last known one, or that have none."""
    known = last.select(*keys, F.col("content_hash").alias("__last"))
    return (
        current.join(known, list(keys), "left")
        .filter(~F.col("content_hash").eqNullSafe(F.col("__last")))
        .drop("__last")
    )
