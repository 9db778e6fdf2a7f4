"""One complete run: changed sheets -> bronze -> silver -> staging -> gold -> reports."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.coerce import to_int
from caseloom.operators import quality
from caseloom.operators.constraints import require_valid
from caseloom.operators.fingerprint import changed_sheets, last_known_hash, sheet_fingerprints
from caseloom.plans.gold import SUMMARY, load_gold, refresh_summary
from caseloom.plans.reports import register_views
from caseloom.plans.resolve import (
    customers_by_number, extend_identity_map, identify, resolve_numbers, resolved_complaints,
    resolved_customers,
)
from caseloom.plans.schema import (
    ALWAYS_FILLED, IDENTITY_MAP, INGESTION_LOG, LINEAGE,
)
from caseloom.plans.silver import PLACES, SILVER, read_silver, refresh_silver
from caseloom.session import tune
from caseloom.sources.sheets import list_sheets, read_bronze, scan_sheets, spread_scan, write_sheets
from caseloom.sources.store import TableStore

EXCLUDED_SHEETS = ("Unresolved",)


@dataclass
class RunResult:
    changed: list[str]
    silver_rows: int = 0
    customers: int = 0
    complaints: int = 0
    findings: list[Row] = field(default_factory=list)


def fingerprint_log(sheets: DataFrame, source_file: str, bronze: str,
                    run_millis: int) -> DataFrame:
    """Current fingerprints in the form of ingestion log rows."""
    return sheet_fingerprints(sheets).select(
        F.col("sheet").alias("sheet_name"),
        F.lit(source_file).alias("source_file"),
        "content_hash",
        "row_count",
        F.concat(F.lit(f"{bronze}/sheet="), F.col("sheet")).alias("bronze_path"),
        F.timestamp_millis(F.lit(run_millis)).alias("processed_at"),
    )


def detect_changes(sheets: DataFrame, log: DataFrame, source_file: str, bronze: str,
                   run_millis: int) -> DataFrame:
    """Log rows of the sheets whose content is not the last known one."""
    current = fingerprint_log(sheets, source_file, bronze, run_millis)
    return changed_sheets(current, last_known_hash(log))


def run(spark: SparkSession, source: str, warehouse: str, client: DataFrame,
        fmt: str = "parquet", exclude: Sequence[str] = EXCLUDED_SHEETS,
        position: str | None = None, run_millis: int | None = None) -> RunResult:
    """Bring the warehouse up to date with the source folder.

    Without a changed sheet nothing is computed or written. The ingestion log is written
    last: a run that fails halfway is simply repeated, since every step before it either
    replaces its output or adds only what is absent.
    """
    run_millis = int(time.time() * 1000) if run_millis is None else run_millis
    store = TableStore(tune(spark), warehouse)
    source_file = source.rstrip("/").rsplit("/", 1)[-1]
    bronze = f"{store.root}/bronze"
    log = store.read_appended(INGESTION_LOG.name, INGESTION_LOG.schema)

    sheets = scan_sheets(spark, source, fmt, exclude, position=position)
    changed = detect_changes(sheets, log, source_file, bronze, run_millis).collect()
    names = sorted(row["sheet_name"] for row in changed)
    if not names:
        return RunResult([])
    entries = spark.createDataFrame(changed, schema=INGESTION_LOG.schema)
    require_valid([(entries, INGESTION_LOG)], {})
    write_sheets(sheets.filter(F.col("sheet").isin(names)), bronze)

    landed = read_bronze(spark, bronze)
    fresh = names if store.exists(PLACES) else sorted(list_sheets(spark, bronze))
    refresh_silver(store, spread_scan(read_bronze(spark, bronze, fresh), *LINEAGE), fresh)
    silver = read_silver(store)
    silver_rows = sum(e["rows"] for e in store.parts(SILVER).values())
    findings = [quality.row_drop(landed, silver, "silver"),
                quality.unexpected_nulls(silver, "silver", ALWAYS_FILLED)]

    store.replace({"numbers": resolve_numbers(customers_by_number(silver), client)})
    numbers = store.read("numbers")
    known = store.read_appended(IDENTITY_MAP.name, IDENTITY_MAP.schema)
    added = extend_identity_map(numbers, known, run_millis)
    require_valid([(known.unionByName(added), IDENTITY_MAP)], {})
    store.append(IDENTITY_MAP.name, added)
    crosswalk = store.read_appended(IDENTITY_MAP.name, IDENTITY_MAP.schema)
    store.replace({"identified": identify(numbers, crosswalk)})
    identified = store.read("identified")
    store.replace({
        "staging_customers": resolved_customers(identified),
        "staging_complaints": resolved_complaints(silver, identified),
    })
    customers, complaints = store.read("staging_customers"), store.read("staging_complaints")
    findings += [quality.duplicate_keys(customers, "staging_customers", "customerId"),
                 quality.orphans(complaints, "staging_complaints", "customerId", customers),
                 quality.ambiguous_phones(client), quality.shared_phones(client)]
    if "TAT" in landed.columns:
        findings.append(quality.lost_values(landed, "bronze", "TAT", to_int))

    upserted, loaded = load_gold(store, customers, complaints)
    gold_customers, gold_complaints = store.read("customers"), store.read("complaints")
    findings += [quality.empty_table(gold_customers, "customers"),
                 quality.empty_table(gold_complaints, "complaints")]
    refresh_summary(store)
    publish(store)
    report = findings[0]
    for finding in findings[1:]:
        report = report.unionByName(finding)
    result = RunResult(names, silver_rows, upserted, loaded, report.collect())

    store.append(INGESTION_LOG.name, entries.coalesce(1))
    return result


def publish(store: TableStore) -> list[str]:
    """Register the reports over the current gold tables and the stored summary."""
    return register_views(
        store.spark,
        store.read("customers"),
        store.read("complaints"),
        store.read(SUMMARY),
    )
