"""Reports that are kept up by changes to the complaints instead of being recomputed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from caseloom.operators.deltas import apply_changes
from caseloom.plans.reports import (
    REGION_MEASURES, TREND_MEASURES, monthly_summary_of, monthly_trends_of, region_counts,
    regional_stats_of, trend_counts,
)
from caseloom.sources.store import TableStore

TREND_COUNTS, REGION_COUNTS = "trend_counts", "region_counts"


@dataclass
class KeptReports:
    """Counts of (month, customer), (month, nature), (month, region) and (region, customer) in a store.

    Their size is that of the different groups, not of the complaints, and a change reads the changed
    rows and the counts only.
    """

    store: TableStore

    def change(self, inserted: DataFrame | None = None, removed: DataFrame | None = None) -> None:
        """Take in rows that came and rows that went; an updated row is both. Both tables of counts
        become current in one commit. The first change starts from nothing."""
        before = {t: self.store.read(t) if self.store.exists(t) else None
                  for t in (TREND_COUNTS, REGION_COUNTS)}
        if inserted is None and removed is None:
            return
        self.store.replace({
            TREND_COUNTS: apply_changes(before[TREND_COUNTS], trend_counts, inserted, removed,
                                        TREND_MEASURES),
            REGION_COUNTS: apply_changes(before[REGION_COUNTS], region_counts, inserted, removed,
                                         REGION_MEASURES),
        })

    def monthly_trends(self) -> DataFrame:
        return monthly_trends_of(self.store.read(TREND_COUNTS))

    def monthly_summary(self) -> DataFrame:
        return monthly_summary_of(self.store.read(TREND_COUNTS))

    def regional_stats(self) -> DataFrame:
        return regional_stats_of(self.store.read(REGION_COUNTS))
