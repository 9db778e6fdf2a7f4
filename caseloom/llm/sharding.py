"""Proportional stratified interleaving into shards, with Spark expressions only.

Within each source the rows are put in a seeded random order and ranked. Rank k of n gets the
fraction (k - phase) / n, where the phase in (0, 1] is a hash of the source, so that many small
sources do not meet at one fraction. All rows sorted by fraction are cut into equal runs: each
shard has the mixture of the whole, to within a row or two of each source.

No window ever holds a whole source. Rows fall into bands of the random key (a uniform hash, so
a source with a third of all rows has a third of every band), ranks are taken inside (source,
band), and counts of the bands before are added; positions in the sorted order are taken likewise
inside bands of the fraction. With n rows there are about sqrt(n) bands of sqrt(n) rows, so both
the windows over rows and the windows over bands hold about sqrt(n) at a time.

Defined results: a null source is a source of its own; a null text has size 0 and the CRC of no
bytes; repeated rows get places of their own; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of the random key: every value is exact in a double.
_KEY_BITS = 48


def random_key(seed: int, *parts: Column) -> Column:
    """Uniform 48-bit number of the parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _KEY_BITS // 4), 16, 10).cast("long")


def _with_rank(df: DataFrame, groups: list[str], band: str, order: list[str],
               name: str) -> DataFrame:
    """Adds ``name``: the rank from 1 inside ``groups``, where ``band`` rises with ``order``."""
    counts = df.groupBy(*groups, band).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(
        *groups, band,
        F.sum("__n").over(
            W.partitionBy(*groups).orderBy(band).rowsBetween(W.unboundedPreceding, -1)
        ).alias("__before"),
    )
    inside = df.withColumn(
        "__inside", F.row_number().over(W.partitionBy(*groups, band).orderBy(*order))
    )
    return inside.join(before, [*groups, band]).withColumn(
        name, F.coalesce("__before", F.lit(0)) + F.col("__inside")
    ).drop("__before", "__inside")


def interleave(docs: DataFrame, shards: int, seed: int = 0, identifier: str = "doc_id",
               text: str = "text", source: str = "source") -> DataFrame:
    """Shard and slot of every row. Columns: doc_id, size, text_crc32, source, shard, slot.

    ``size`` is the UTF-8 length plus 8. Shard counts differ by one row at most.
    """
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = docs.select(
        F.col(identifier).alias("doc_id"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(source).isNull().alias("no_source"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    ).withColumn("draw", random_key(seed, F.col("doc_id")))
    total = rows.count()
    bands = max(1, math.isqrt(total))
    width = -(-(1 << _KEY_BITS) // bands)
    ranked = _with_rank(
        rows.withColumn("band", F.expr(f"draw div {width}")),
        ["source", "no_source"], "band", ["draw", "doc_id", "text_crc32", "size"], "rank",
    )
    sizes = rows.groupBy("source", "no_source").agg(F.count(F.lit(1)).alias("rows_of_source"))
    phase = (random_key(seed, F.col("source"), F.col("no_source")) + 1) / F.lit(1 << _KEY_BITS)
    spread = ranked.join(sizes, ["source", "no_source"]).withColumn(
        "fraction", (F.col("rank") - phase) / F.col("rows_of_source")
    ).withColumn("slice", F.least(F.floor(F.col("fraction") * bands), F.lit(bands - 1)))
    placed = _with_rank(
        spread.withColumn("all", F.lit(0)), ["all"], "slice",
        ["fraction", "source", "no_source", "doc_id", "text_crc32", "size"], "place",
    )
    # Shard s takes the places from ceil(s * total / shards) up to the next such bound.
    shard = F.expr(f"(place - 1) * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32",
        F.when(~F.col("no_source"), F.col("source")).alias("source"),
        "shard", (F.col("place") - 1 - first).cast("long").alias("slot"),
    )
