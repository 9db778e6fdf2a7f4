"""Connected components of a table of links, by alternating large and small stars.

Each round moves every link towards the smallest node that either end knows, with groupings that
combine before the shuffle and joins that Spark can split; the rounds end when links stop changing.
No links leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tables import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than a node goes to the smallest node of its neighbourhood."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("centre"), F.least("u", "low").alias("low"))
    return both.filter("v > u").join(least, F.col("u") == F.col("centre")).select(
        F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these. Needs u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("centre"), "low")
    joined = links.join(least, F.col("u") == F.col("centre"))
    moved = joined.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(least.select(F.col("centre").alias("u"), F.col("low").alias("v"))) \
        .distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for nodes other than roots.
    ``links`` has the columns u and v, numbers in any order."""
    current = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .filter("u <> v").distinct(), "links")
    before = None
    while (now := _state(current)) != before:
        before = now
        if not now[0]:
            break
        last, current = current, stored(_small_star(_large_star(current)), "links")
        discard(last)
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
