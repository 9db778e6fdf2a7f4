"""Silver to staging: who each complaint belongs to.

Everything about a person follows from the phone number. So numbers are reduced to one row
each first, resolved there, and complaints take a single join by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.dedupe import drop_unidentified, first_per_key
from caseloom.operators.identity import (
    mint_ids, new_keys, phone_lookup, resolution_key, split_columns,
)
from caseloom.operators.joins import lookup_join
from caseloom.plans.schema import (
    COMPLAINT_COLUMNS, COMPLAINTS, CUSTOMER_COLUMNS, CUSTOMERS, IDENTITY_MAP, LINEAGE,
)
from caseloom.session import stored


def split_customers(silver: DataFrame) -> DataFrame:
    return split_columns(silver, CUSTOMER_COLUMNS).distinct()


def split_complaints(silver: DataFrame) -> DataFrame:
    return split_columns(silver, COMPLAINT_COLUMNS)


def customers_by_number(silver: DataFrame) -> DataFrame:
    """First silver row of each number, with its lineage: one row per number."""
    rows = split_columns(silver, [*CUSTOMER_COLUMNS, *LINEAGE])
    return first_per_key(drop_unidentified(rows, ["number"]), "number", LINEAGE, silver)


def resolve_numbers(numbers: DataFrame, client: DataFrame) -> DataFrame:
    """Add profileId, number2 and resolution_key to a frame with one row per number.

    The frame is stored first, as the join asks for its hot keys in a job of its own.
    """
    known = lookup_join(stored(numbers, "first-rows"), phone_lookup(client), "number", "left")
    return known.withColumn(
        "resolution_key", resolution_key(F.col("profileId"), F.col("number"))
    )


def identify(numbers: DataFrame, identity_map: DataFrame) -> DataFrame:
    """Numbers with the customerId that the crosswalk has for their resolution key. Staging customers
    and complaints both use it, so a run stores it once."""
    ids = identity_map.select("resolution_key", F.col("customer_id").alias("customerId"))
    return numbers.join(ids, "resolution_key", "inner").drop("resolution_key")


def resolved_customers(identified: DataFrame) -> DataFrame:
    """One row per customerId: the earliest row of any of the customer's numbers.

    A profile has few numbers, so no key is hot here.
    """
    return first_per_key(identified, "customerId", LINEAGE).select(*CUSTOMERS.column_names)


def resolved_complaints(silver: DataFrame, identified: DataFrame) -> DataFrame:
    """Complaints with their customerId; those without a number belong to nobody and go."""
    identity = identified.select("number", "profileId", "number2", "customerId")
    complaints = drop_unidentified(split_complaints(silver), ["number"])
    return lookup_join(complaints, identity, "number", "inner").select(
        *COMPLAINTS.column_names
    )


def extend_identity_map(numbers: DataFrame, identity_map: DataFrame,
                        run_millis: int) -> DataFrame:
    """The crosswalk rows this run adds."""
    return mint_ids(new_keys(numbers, identity_map), run_millis)


def resolve(silver: DataFrame, client: DataFrame, identity_map: DataFrame,
            run_millis: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customers, complaints, crosswalk after the run), without writing any table."""
    numbers = resolve_numbers(customers_by_number(silver), client)
    known = identity_map.select(*IDENTITY_MAP.column_names)
    crosswalk = known.unionByName(extend_identity_map(numbers, known, run_millis))
    identified = identify(numbers, crosswalk)
    return resolved_customers(identified), resolved_complaints(silver, identified), crosswalk
