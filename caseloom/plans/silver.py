"""Silver kept up from changed sheets.

Silver holds the distinct cleaned rows of all sheets, each under the place of its first copy. Beside it is
a narrow table of where copies are: per row digest and sheet the number of copies and the first of them.
When sheets change, their old places count as removed and their new ones as added; only rows with such a
digest can get another first place, come or go. Both tables are stored in parts by a hash of the sheet,
and only parts with such rows are written again. Values of a row that moves to a sheet that did not change are taken from
its old place, as equal digests have equal values: unchanged sheets of bronze are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.dedupe import has_value
from caseloom.operators.parts import key_part
from caseloom.operators.turnaround import validate_turnaround
from caseloom.plans.clean import clean_values
from caseloom.plans.schema import ALWAYS_FILLED, LINEAGE
from caseloom.session import scratch_path
from caseloom.sources.store import PART, TableStore

SILVER, PLACES = "silver", "silver_places"
DIGEST = "row_digest"
_CONSTRAINTS = "spark.sql.constraintPropagation.enabled"
#: Parts that sheets fall into; must stay what it was when the tables were first written.
SHEET_PARTS = 16


def part_of(sheet: str) -> str:
    """Name of a sheet's part, as ``key_part`` gives it."""
    return str(int(hashlib.md5(sheet.encode()).hexdigest()[:8], 16) % SHEET_PARTS).zfill(6)


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of a row's values by name. Null and absent are the same, so that a column which a
    later sheet adds changes no digest."""
    parts = [F.concat(F.lit(f"{c}:"), F.length(F.col(c).cast("string")).cast("string"), F.lit("="),
                      F.col(c).cast("string")) for c in sorted(columns)]
    return F.unhex(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32))


def cleaned_copies(bronze: DataFrame) -> DataFrame:
    """Different non-blank cleaned rows of each sheet, with their digest, the row of the first copy
    and the number of copies ``n``."""
    sheet, row = LINEAGE
    rows = clean_values(bronze)
    business = [c for c in rows.columns if c not in LINEAGE]
    telling = [c for c in business if c not in ALWAYS_FILLED]
    groups = rows.groupBy(*business, sheet).agg(F.min(row).alias(row), F.count(F.lit(1)).alias("n"))
    # Tied to the aggregate, as a condition on many columns is costly to plan below it, and there repeats
    # the cleaning of these columns. That a count is not null would be known, so it ties nothing.
    kept = groups.filter(F.when(F.col("n") > 0, has_value(telling)))
    return validate_turnaround(kept.withColumn(DIGEST, row_digest(business)))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back. Planned without constraint propagation, which takes
    exponential time where conditions and digests use all of many columns."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CONSTRAINTS)
    spark.conf.set(_CONSTRAINTS, "false")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CONSTRAINTS, before)
    return spark.read.schema(df.schema).parquet(path)


def _first_places(places: DataFrame, name: str) -> DataFrame:
    return places.groupBy(DIGEST).agg(F.min(F.struct(*LINEAGE)).alias(name))


def _of_first_places(rows: DataFrame) -> DataFrame:
    """Of each digest the row of the first place. Only digests with several rows are looked up, so where
    they are few the wide rows are not shuffled."""
    shared = _stored(rows.groupBy(DIGEST).agg(
        F.min(F.struct(*LINEAGE)).alias("home"), F.count(F.lit(1)).alias("__rows"),
    ).filter(F.col("__rows") > 1).drop("__rows"), "shared-digests")
    return rows.join(shared, DIGEST, "left").filter(
        F.col("home").isNull() | (F.struct(*LINEAGE) == F.col("home"))).drop("home")


def refresh_silver(store: TableStore, bronze: DataFrame, changed: Sequence[str]) -> list[str]:
    """Take in the changed sheets, of which ``bronze`` has all rows and no others. Returns the parts
    of silver that were written."""
    sheet, _ = LINEAGE
    fresh = _stored(cleaned_copies(bronze), "cleaned-copies")
    new = fresh.select(DIGEST, *LINEAGE, "n")
    of_changed = sorted({part_of(s) for s in changed})

    def parted(df: DataFrame) -> DataFrame:
        # Rebalanced, so that a part with many rows, or several parts of one task, are cut at run time.
        return df.withColumn(PART, key_part(F.col(sheet), SHEET_PARTS)).hint("rebalance", F.col(PART))

    if not store.exists(SILVER) or not store.exists(PLACES):
        rows = _of_first_places(fresh.drop("n"))
        store.replace({}, {SILVER: (parted(rows), of_changed), PLACES: (parted(new), of_changed)})
        return of_changed

    is_changed = F.col(sheet).isin(list(changed))
    places = store.read(PLACES)
    old = places.filter(is_changed)
    touched = _stored(old.select(DIGEST).unionByName(new.select(DIGEST)).distinct(), "touched-digests")
    elsewhere = _stored(places.filter(~is_changed).join(touched, DIGEST, "left_semi"), "places-elsewhere")
    homes = touched.join(_first_places(elsewhere.unionByName(old), "before"), DIGEST, "left").join(
        _first_places(elsewhere.unionByName(new), "after"), DIGEST, "left")
    here = F.col(f"after.{sheet}").isin(list(changed))
    stays = F.col("before").eqNullSafe(F.col("after")) & ~here
    moved = _stored(homes.filter(~F.coalesce(stays, F.lit(False))), "moved-rows")
    ends = moved.select(F.explode(F.array(f"before.{sheet}", f"after.{sheet}")).alias(sheet)).distinct()
    written = sorted({*of_changed, *[part_of(r[0]) for r in ends.collect() if r[0] is not None]})

    held = store.read(SILVER, written)
    stay = held.join(moved.select(DIGEST), DIGEST, "left_anti")
    from_sheets = fresh.drop("n").join(moved.filter(here).select(DIGEST, "after"), DIGEST).filter(
        F.struct(*LINEAGE) == F.col("after")).drop("after")
    from_silver = held.join(moved.filter(~here).select(DIGEST, "after"), DIGEST).withColumns(
        {c: F.col(f"after.{c}") for c in LINEAGE}).drop("after")
    rows = stay.unionByName(from_silver).unionByName(from_sheets, allowMissingColumns=True)
    kept = store.read(PLACES, of_changed).filter(~is_changed)
    store.replace({}, {SILVER: (parted(rows), written),
                       PLACES: (parted(kept.unionByName(new)), of_changed)})
    return written


def read_silver(store: TableStore) -> DataFrame:
    return store.read(SILVER).drop(DIGEST)
