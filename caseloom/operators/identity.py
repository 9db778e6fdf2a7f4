"""Resolving people to stable identifiers through phone numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.ids import time_sortable_id
from caseloom.operators.joins import lookup_join


def split_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns, as far as they exist."""
    return df.select(*[c for c in columns if c in df.columns])


def phone_lookup(client: DataFrame) -> DataFrame:
    """(number, profileId, number2): one row per phone number of the client table.

    A primary number beats a secondary one; of clients sharing a number the smallest
    profileId wins. ``number2`` is that client's own second number. The client table is read
    once, with three columns.
    """
    phones = client.select(
        "profileId",
        F.col("phoneNumber2").alias("number2"),
        F.explode(
            F.array(
                F.struct(F.col("phoneNumber").alias("number"), F.lit(0).alias("priority")),
                F.struct(F.col("phoneNumber2").alias("number"), F.lit(1).alias("priority")),
            )
        ).alias("phone"),
    ).select("profileId", "number2", "phone.*")
    best = F.min(F.struct("priority", "profileId", "number2")).alias("best")
    return (
        phones.filter(F.col("number").isNotNull()).groupBy("number").agg(best)
        .select("number", "best.profileId", "best.number2")
    )


def attach_profile(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add profileId and number2 by phone number; null where the number is unknown."""
    return lookup_join(df, lookup, "number", "left")


def resolution_key(profile_id: Column, number: Column) -> Column:
    """The profile if known, else the number; null without both."""
    return F.coalesce(profile_id, F.concat(F.lit("number:"), number))


def new_keys(keys: DataFrame, identity_map: DataFrame) -> DataFrame:
    """Distinct resolution keys that the crosswalk lacks."""
    return (
        keys.select("resolution_key").filter(F.col("resolution_key").isNotNull()).distinct()
        .join(identity_map.select("resolution_key"), "resolution_key", "left_anti")
    )


def mint_ids(keys: DataFrame, run_millis: int) -> DataFrame:
    """Crosswalk rows for new keys."""
    return keys.select(
        "resolution_key",
        time_sortable_id(F.col("resolution_key"), run_millis).alias("customer_id"),
        F.timestamp_millis(F.lit(run_millis)).alias("first_seen"),
    )


def keep_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``known``."""
    return lookup_join(df, known.select(key).distinct(), key, "left_semi")
