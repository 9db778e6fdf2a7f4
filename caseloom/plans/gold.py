"""Staging to gold, and the stored summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.constraints import require_valid
from caseloom.operators.parts import upsert_parts
from caseloom.plans.reports import monthly_summary
from caseloom.plans.schema import COMPLAINTS, CUSTOMERS
from caseloom.sources.store import PART, TableStore

SUMMARY = "mv_monthly_complaint_summary"
#: Parts of the customers table; a load rewrites those that its customers fall into.
CUSTOMER_PARTS = 16


def refreshed_complaints(staged: DataFrame) -> DataFrame:
    """Complaints after the load: the staged ones, with an id unique within this load."""
    return staged.select(
        F.monotonically_increasing_id().alias("id"), *COMPLAINTS.column_names
    )


def load_gold(store: TableStore, customers: DataFrame, complaints: DataFrame,
              parts: int = CUSTOMER_PARTS) -> tuple[int, int]:
    """Upsert customers, replace complaints; returns the rows loaded from staging of each.

    Constraints are checked first and a violation aborts with nothing written. Both tables
    become current in one commit, so no reader sees new customers with old complaints. Of the
    customers, stored in ``parts`` by their identifier, only the parts with staged ones are rewritten.
    """
    staged = customers.select(*CUSTOMERS.column_names)
    merged, after, touched = upsert_parts(store, "customers", staged, "customerId", parts)
    require_valid(
        [(customers, CUSTOMERS), (complaints, COMPLAINTS)], {"customers": after}
    )
    upserted = customers.count()
    written = store.replace(
        {"complaints": refreshed_complaints(complaints)},
        {"customers": (merged.hint("rebalance", F.col(PART)), touched)},
    )
    return upserted, written["complaints"]


def refresh_summary(store: TableStore) -> int:
    """Recompute the stored monthly summary. Readers see the old one until this commits."""
    return store.replace({SUMMARY: monthly_summary(store.read("complaints"))})[SUMMARY]
