"""Joins that hold when one key has a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import scratch_path

#: A key with more rows than this is cut into slices of about this many rows, fewer where rows
#: are so wide that a slice would exceed ``SLICE_BYTES``.
SLICE_ROWS = 1_000_000
SLICE_BYTES = 256 << 20

_SALT, _SLICES = "__slice", "__slices"


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimiser's size estimate, None where the session does not expose it."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def is_broadcastable(df: DataFrame) -> bool:
    """True if the estimated size is under the session's own broadcast threshold."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not limit.lstrip("-").isdigit():
        units = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils
        limit = units.byteStringAsBytes(limit)
    size = estimated_bytes(df)
    return size is not None and size <= int(limit)


def rows_per_slice(df: DataFrame, rows: int | None = None) -> int:
    """Rows that make a slice, by the optimiser's estimate of their width. ``rows`` is how many there
    are, where that is known already."""
    size = estimated_bytes(df)
    if size is None:
        return SLICE_ROWS
    width = max(1, size // max(1, df.count() if rows is None else rows))
    return max(1, min(SLICE_ROWS, SLICE_BYTES // width))


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Stored table of the keys (null included) with more than ``slice_rows`` rows and the number
    of slices of each: at most one in ``slice_rows`` of the rows.

    Counts combine before the shuffle, and only the key column is read. The answer steers the
    layout of a join only, never its result.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    hot = counts.select(key, F.ceil(F.col("n") / slice_rows).cast("int").alias(_SLICES))
    path = scratch_path(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    return df.sparkSession.read.schema(hot.schema).parquet(path)


def _with_slices(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Adds the number of slices of each row's key: 1 for most."""
    known = hot.select(F.col(key).alias("__hot"), _SLICES)
    if is_broadcastable(hot):
        known = F.broadcast(known)
    return df.join(known, F.col(key).eqNullSafe(F.col("__hot")), "left").drop("__hot") \
        .withColumn(_SLICES, F.coalesce(_SLICES, F.lit(1)))


def sliced_join(left: DataFrame, right: DataFrame, key: str, how: str,
                hot: DataFrame) -> DataFrame:
    """Equi-join that spreads the rows of each hot left key over several slices.

    The slice is a function of the row and of the number of its input partition: equal rows
    are spread too, and a retried task puts each row where it was. Right rows of a hot key are
    repeated once per slice; all others stay single.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"sliced_join keeps left rows whole; unsupported: {how}")
    row_hash = F.xxhash64(F.spark_partition_id(), *[left[c] for c in left.columns])
    drawn = left.withColumn("__draw", row_hash)
    spread = _with_slices(drawn, key, hot).withColumn(
        _SALT, F.pmod("__draw", F.col(_SLICES)).cast("int")).drop("__draw", _SLICES)
    repeated = _with_slices(right, key, hot).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.col(_SLICES) - 1))).drop(_SLICES)
    return spread.join(repeated, [key, _SALT], how).drop(_SALT)


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left",
                slice_rows: int | None = None) -> DataFrame:
    """Join a large frame to its lookup table on one column.

    A lookup of checked small size is broadcast, and left rows do not move. Otherwise hot left
    keys, if there are any, are sliced; without any it is the plain shuffle join. One job over the key
    column tells whether there are any, and only then they are listed.
    """
    if is_broadcastable(right):
        return left.join(F.broadcast(right), key, how)
    rows, most = left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    slice_rows = slice_rows or rows_per_slice(left, rows or 0)
    if (most or 0) <= slice_rows:
        return left.join(right, key, how)
    return sliced_join(left, right, key, how, hot_keys(left, key, slice_rows))
