"""Every operator applied to the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.coerce import to_calendar_date, to_int
from caseloom.functions.phone import e164
from caseloom.functions.text import default_name, strip, title_case
from caseloom.operators import quality
from caseloom.operators.canonical import canonicalise
from caseloom.operators.constraints import (
    Column as DeclaredColumn, Table, column_violations, foreign_key_violations, unique_violations,
    violations,
)
from caseloom.operators.dedupe import drop_unidentified
from caseloom.operators.fingerprint import changed_sheets, last_known_hash, sheet_fingerprints
from caseloom.operators.identity import (
    attach_profile, keep_known, mint_ids, new_keys, phone_lookup, resolution_key,
)
from caseloom.operators.merge import insert_if_absent
from caseloom.operators.parts import key_part
from caseloom.operators.turnaround import (
    recompute_negative, swap_reversed_dates, validate_turnaround,
)
from caseloom.plans import reports
from caseloom.plans.clean import (
    clean, meaningful_rows, rename_headers, standardise_values, to_silver,
)
from caseloom.plans.gold import SUMMARY, load_gold, refresh_summary
from caseloom.plans.kept import KeptReports
from caseloom.plans.resolve import (
    customers_by_number, extend_identity_map, identify, resolve_numbers, resolved_complaints,
    resolved_customers, split_complaints, split_customers,
)
from caseloom.plans.run import fingerprint_log, run
from caseloom.plans.silver import read_silver, refresh_silver
from caseloom.plans.schema import (
    ALWAYS_FILLED, CLIENT, COMPLAINTS, CUSTOMERS, IDENTITY_MAP, INGESTION_LOG,
    LINEAGE, REGION_THRESHOLD,
    REGIONS,
)
from caseloom.session import scratch_path, tune
from caseloom.sources.sheets import (
    CSV_WRITE_OPTIONS, list_sheets, read_bronze, scan_sheets, stringify, write_sheets,
)
from caseloom.sources.store import TableStore
from workloads.fixture import client, raw_complaints, table
from workloads.parameters import (
    EXCLUDED_SHEET, RUN_MILLIS, SECOND_RUN_MILLIS, SOURCE_FILE, SPLIT_DATE, SPLIT_SHEET,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = tuned
    return function


# Shared stages -------------------------------------------------------------------------------

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringify(raw_complaints(spark, sf_dir), keep=("row_idx",))


def deliver(rows: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Write sheets as a source would: few files each, a large sheet in several."""
    write_sheets(rows.repartitionByRange("sheet", "row_idx"), root, fmt)


def new_store(spark: SparkSession, name: str) -> TableStore:
    return TableStore(spark, scratch_path(spark, name))


def stored_silver(spark: SparkSession, sf_dir: str, store: TableStore) -> DataFrame:
    store.replace({"silver": to_silver(bronze(spark, sf_dir))})
    return store.read("silver")


def crosswalk_of(numbers: DataFrame, run_millis: int = RUN_MILLIS) -> DataFrame:
    empty = numbers.sparkSession.createDataFrame([], IDENTITY_MAP.schema)
    return extend_identity_map(numbers, empty, run_millis)


def stage(spark: SparkSession, silver: DataFrame, sf_dir: str,
          store: TableStore) -> tuple[DataFrame, DataFrame]:
    """Customers and complaints of a first run, written as a run does."""
    store.replace({"numbers": resolve_numbers(customers_by_number(silver), client(spark, sf_dir))})
    numbers = store.read("numbers")
    store.replace({"identified": identify(numbers, crosswalk_of(numbers))})
    identified = store.read("identified")
    store.replace({
        "staging_customers": resolved_customers(identified),
        "staging_complaints": resolved_complaints(silver, identified),
    })
    return store.read("staging_customers"), store.read("staging_complaints")


def gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    store = new_store(spark, "gold")
    return stage(spark, stored_silver(spark, sf_dir, store), sf_dir, store)


def is_earlier():
    return F.col("sheet") < SPLIT_SHEET


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[TableStore, tuple[int, int]]:
    """Gold after loading the earlier sheets, then the later ones; counts of the second."""
    store = new_store(spark, "loads")
    silver = stored_silver(spark, sf_dir, store)
    load_gold(store, *stage(spark, silver.filter(is_earlier()), sf_dir, store))
    counts = load_gold(store, *stage(spark, silver.filter(~is_earlier()), sf_dir, store))
    return store, counts


# Sources and sinks ---------------------------------------------------------------------------

@query
def scan_csv_sheets(spark, sf_dir):
    root = scratch_path(spark, SOURCE_FILE)
    deliver(bronze(spark, sf_dir), root, "csv")
    return scan_sheets(spark, root, "csv", position="row_idx")


@query
def scan_numbered_csv(spark, sf_dir):
    """Sheets without a position column, in several files each: rows count in file order."""
    root = scratch_path(spark, SOURCE_FILE)
    ordered = bronze(spark, sf_dir).repartitionByRange("sheet", "row_idx") \
        .sortWithinPartitions("sheet", "row_idx")
    write_sheets(ordered.drop("row_idx"), root, "csv")
    return scan_sheets(spark, root, "csv")


def _two_kinds(even: DataFrame, odd: DataFrame, root: str, fmt: str) -> None:
    """Both into the same sheets, as files of their own."""
    write_sheets(even, root, fmt)
    options = CSV_WRITE_OPTIONS if fmt == "csv" else {}
    odd.write.mode("append").options(**options).partitionBy("sheet").format(fmt).save(root)


@query
def scan_mixed_headers(spark, sf_dir):
    """Files of one sheet with other columns in another order."""
    root = scratch_path(spark, SOURCE_FILE)
    rows = bronze(spark, sf_dir)
    odd = rows.filter("row_idx % 2 <> 0")
    _two_kinds(rows.filter("row_idx % 2 = 0"),
               odd.select(*[c for c in reversed(odd.columns) if c != "DOB"]), root, "csv")
    return scan_sheets(spark, root, "csv", position="row_idx")


@query
def scan_mixed_types(spark, sf_dir):
    """Files of one sheet with a number in one and a text and one more column in the other."""
    root = scratch_path(spark, SOURCE_FILE)
    rows = bronze(spark, sf_dir)
    even = rows.filter("row_idx % 2 = 0").withColumn(
        "TAT", F.when(F.col("TAT").rlike("^-?[0-9]+$"), F.col("TAT").try_cast("int")))
    _two_kinds(even.drop("UPDATES"), rows.filter("row_idx % 2 <> 0"), root, "parquet")
    return scan_sheets(spark, root, position="row_idx")


def _told_in_lines() -> Column:
    return F.concat(F.lit('said "'), "STATUS", F.lit('",\n\nthen\r\nrang'))


@query
def scan_multiline_cells(spark, sf_dir):
    """Line breaks and quotes inside cells."""
    root = scratch_path(spark, SOURCE_FILE)
    rows = bronze(spark, sf_dir).withColumn("DETAILS OF COMPLAINT", _told_in_lines())
    deliver(rows, root, "csv")
    return scan_sheets(spark, root, "csv", position="row_idx")


def deliver_in_order(rows: DataFrame, root: str, sheet: str) -> None:
    """All rows as one CSV sheet in the order of ``sheet`` and ``row_idx``, which become cells. The sheet is
    cut into files of consecutive rows, as many as there are ranges to sort: no task writes all of it."""
    one = rows.sort("sheet", "row_idx").withColumnsRenamed({"sheet": "ORIGIN", "row_idx": "PLACE"})
    one.write.options(**CSV_WRITE_OPTIONS).csv(f"{root}/sheet={sheet}")


@query
def scan_large_csv(spark, sf_dir):
    """All rows as one sheet of large files with line breaks in cells, read in splits far smaller than
    the files."""
    root = scratch_path(spark, SOURCE_FILE)
    rows = bronze(spark, sf_dir).withColumn("DETAILS OF COMPLAINT", _told_in_lines())
    deliver_in_order(rows, root, "ALL")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200k")
    try:
        return scan_sheets(spark, root, "csv")
    finally:
        spark.conf.set(size, before)


@query
def empty_sheets_skipped(spark, sf_dir):
    """A sheet of an empty file gives no rows, and a source of nothing else is no change."""
    root = scratch_path(spark, SOURCE_FILE)
    nothing = spark.createDataFrame([], "value string")
    deliver(bronze(spark, sf_dir), root, "csv")
    empty = f"{scratch_path(spark, 'empty')}/{SOURCE_FILE}"
    for folder in (root, empty):
        nothing.write.text(f"{folder}/sheet=EMPTY")
    sheets = scan_sheets(spark, root, "csv", position="row_idx")
    left = run(spark, empty, scratch_path(spark, "warehouse"), client(spark, sf_dir), fmt="csv")
    counted = sheets.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"))
    of_empty = scan_sheets(spark, root, "csv", only=["EMPTY"]).count()
    return counted.select("sheet", "n", F.lit(of_empty).cast("long").alias("rows_of_empty"),
                          F.lit(len(left.changed)).cast("long").alias("changed_in_empty"))


@query
def exclude_sheets(spark, sf_dir):
    root = scratch_path(spark, SOURCE_FILE)
    deliver(raw_complaints(spark, sf_dir), root)
    return scan_sheets(spark, root, exclude=[EXCLUDED_SHEET], position="row_idx")


@query
def stringify_columns(spark, sf_dir):
    return bronze(spark, sf_dir)


@query
def land_bronze(spark, sf_dir):
    """Landing the later sheets again replaces these and leaves the earlier ones."""
    root = scratch_path(spark, "bronze")
    rows = bronze(spark, sf_dir)
    deliver(rows, root)
    deliver(rows.filter(~is_earlier()).withColumn("UPDATES", F.lit("revised")), root)
    return read_bronze(spark, root)


@query
def union_by_name(spark, sf_dir):
    """Earlier and later sheets with different columns, in one folder."""
    root = scratch_path(spark, "bronze")
    rows = bronze(spark, sf_dir)
    deliver(rows.filter(is_earlier()).drop("NUMBER2", "DOB"), root)
    deliver(rows.filter(~is_earlier()).drop("UPDATES"), root)
    return read_bronze(spark, root)


@query
def silver_table(spark, sf_dir):
    return stored_silver(spark, sf_dir, new_store(spark, "silver"))


@query
def silver_from_changes(spark, sf_dir):
    """Silver after two loads: first the earlier sheets, one of them with other values and with copies of
    rows of later sheets, then this one as it is and the later sheets."""
    store = new_store(spark, "silver")
    root = scratch_path(spark, "bronze")
    rows = bronze(spark, sf_dir)
    odd = F.col("sheet") == EXCLUDED_SHEET
    copies = rows.filter(~is_earlier() & (F.col("row_idx") % 3 == 0)).withColumns(
        {"sheet": F.lit(EXCLUDED_SHEET), "row_idx": F.col("row_idx") + 2_000_000_000})
    first = rows.filter(is_earlier() & ~odd).unionByName(copies).unionByName(
        rows.filter(odd).withColumn("STATUS", F.lit("other")))
    deliver(first, root)
    refresh_silver(store, read_bronze(spark, root), sorted(list_sheets(spark, root)))
    second = rows.filter(~is_earlier() | odd)
    deliver(second, root)
    changed = sorted(r[0] for r in second.select("sheet").distinct().collect())
    refresh_silver(store, read_bronze(spark, root, changed), changed)
    return read_silver(store)


@query
def staging_replace(spark, sf_dir):
    """The second write of a staging table is what is read, whatever the first one held."""
    store = new_store(spark, "staging")
    silver = stored_silver(spark, sf_dir, store)
    store.replace({"staging": split_customers(silver)})
    store.replace({"staging": split_complaints(silver)})
    return store.read("staging")


@query
def upsert_customers(spark, sf_dir):
    store, _ = two_loads(spark, sf_dir)
    return store.read("customers")


@query
def upsert_touched_parts(spark, sf_dir):
    """Customers in 256 parts after a load of all sheets but the last and one of the last: which
    parts the second load wrote, the others being the files of the first."""
    store = new_store(spark, "parts")
    silver = stored_silver(spark, sf_dir, store)
    last = silver.agg(F.max("sheet")).first()[0]
    load_gold(store, *stage(spark, silver.filter(F.col("sheet") < last), sf_dir, store), parts=256)
    first = {p: e["path"] for p, e in store.parts("customers").items()}
    load_gold(store, *stage(spark, silver.filter(F.col("sheet") == last), sf_dir, store), parts=256)
    rewritten = spark.createDataFrame(
        [(p, e["path"] != first.get(p)) for p, e in store.parts("customers").items()],
        "part string, rewritten boolean")
    return store.read("customers").withColumn("part", key_part(F.col("customerId"), 256)) \
        .join(F.broadcast(rewritten), "part")


@query
def replace_complaints(spark, sf_dir):
    store, _ = two_loads(spark, sf_dir)
    return store.read("complaints").drop("id")


@query
def gold_load_counts(spark, sf_dir):
    _, (customers, complaints) = two_loads(spark, sf_dir)
    return spark.createDataFrame(
        [(customers, complaints)], "customers long, complaints long"
    )


@query
def insert_absent_keys(spark, sf_dir):
    """The crosswalk of the earlier sheets, then that of all sheets inserted into it."""
    store = new_store(spark, "crosswalk")
    silver = stored_silver(spark, sf_dir, store)
    store.replace({
        "earlier": _resolved_numbers(spark, silver.filter(is_earlier()), sf_dir),
        "all": _resolved_numbers(spark, silver, sf_dir),
    })
    return insert_if_absent(
        crosswalk_of(store.read("earlier")),
        crosswalk_of(store.read("all"), SECOND_RUN_MILLIS),
        ["resolution_key"],
    ).select("resolution_key", "customer_id")


@query
def registered_views(spark, sf_dir):
    customers, complaints = gold(spark, sf_dir)
    reports.register_views(spark, customers, complaints)
    return spark.table("vw_complaint_status")


# Change detection ----------------------------------------------------------------------------

@query
def sheet_fingerprint(spark, sf_dir):
    return sheet_fingerprints(bronze(spark, sf_dir))


@query
def last_hash_per_key(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sheet_name"), F.col("event_type").alias("source_file"),
        F.col("props").alias("content_hash"), F.col("ts").alias("processed_at"),
    )
    return last_known_hash(log)


def _fingerprints(rows: DataFrame, run_millis: int) -> DataFrame:
    return fingerprint_log(rows, SOURCE_FILE, "bronze", run_millis)


@query
def changed_sheets_only(spark, sf_dir):
    """The log knows the earlier sheets, one of them with other content."""
    rows = bronze(spark, sf_dir)
    status = F.when(F.col("sheet") == EXCLUDED_SHEET, F.upper("STATUS")).otherwise(F.col("STATUS"))
    before = rows.filter(is_earlier()).withColumn("STATUS", status)
    last = last_known_hash(_fingerprints(before, RUN_MILLIS))
    return changed_sheets(_fingerprints(rows, SECOND_RUN_MILLIS), last).select(
        "sheet_name", "content_hash", "row_count"
    )


@query
def log_ingestion(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return insert_if_absent(
        _fingerprints(rows.filter(is_earlier()), RUN_MILLIS),
        _fingerprints(rows, SECOND_RUN_MILLIS),
        ["sheet_name", "source_file", "content_hash"],
    ).withColumn("processed_at", F.unix_millis("processed_at"))


@query
def unchanged_run(spark, sf_dir):
    """Two complete runs over the same sheets: the log has one entry per sheet, and the second
    run finds nothing to do."""
    source = scratch_path(spark, SOURCE_FILE)
    deliver(raw_complaints(spark, sf_dir), source)
    warehouse = scratch_path(spark, "warehouse")
    people = client(spark, sf_dir)
    run(spark, source, warehouse, people, position="row_idx", run_millis=RUN_MILLIS)
    second = run(
        spark, source, warehouse, people, position="row_idx", run_millis=SECOND_RUN_MILLIS
    )
    return spark.read.parquet(f"{warehouse}/ingestion_log").select(
        "sheet_name", "content_hash", "row_count",
        F.lit(len(second.changed)).cast("long").alias("changed_in_second_run"),
    )


# Cleaning ------------------------------------------------------------------------------------

def _of_bronze(spark, sf_dir, **columns) -> DataFrame:
    return bronze(spark, sf_dir).select(
        *LINEAGE, *[c.alias(name) for name, c in columns.items()]
    )


@query
def lower_camel_headers(spark, sf_dir):
    return rename_headers(bronze(spark, sf_dir))


@query
def name_default(spark, sf_dir):
    return _of_bronze(spark, sf_dir, name=default_name(F.col("NAME")))


@query
def coerce_int(spark, sf_dir):
    return _of_bronze(spark, sf_dir, turnaroundTime=to_int(F.col("TAT")))


@query
def coerce_date(spark, sf_dir):
    return _of_bronze(
        spark, sf_dir,
        logDate=to_calendar_date(F.col("LOG DATE")),
        resolutionDate=to_calendar_date(F.col("RESOLUTION DATE")),
        dateOfBirth=to_calendar_date(F.col("DOB")),
    )


@query
def day_difference(spark, sf_dir):
    days = F.datediff(
        to_calendar_date(F.col("RESOLUTION DATE")), to_calendar_date(F.col("LOG DATE"))
    )
    return _of_bronze(spark, sf_dir, days=days)


@query
def trim_text(spark, sf_dir):
    rows = rename_headers(bronze(spark, sf_dir))
    return rows.select(*[c if c in LINEAGE else strip(F.col(c)).alias(c) for c in rows.columns])


@query
def title_case_text(spark, sf_dir):
    rows = rename_headers(bronze(spark, sf_dir))
    return rows.select(
        *[c if c in LINEAGE else title_case(F.col(c)).alias(c) for c in rows.columns]
    )


@query
def title_case_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", title_case(F.col("text")).alias("titled")
    )


@query
def fuzzy_region(spark, sf_dir):
    regions = _of_bronze(spark, sf_dir, region=title_case(strip(F.col("REGION"))))
    return canonicalise(regions, "region", REGIONS, REGION_THRESHOLD)


@query
def phone_e164(spark, sf_dir):
    return _of_bronze(
        spark, sf_dir, number=e164(F.col("NUMBER")), number2=e164(F.col("NUMBER2"))
    )


@query
def standard_values(spark, sf_dir):
    return standardise_values(rename_headers(bronze(spark, sf_dir)))


@query
def distinct_cleaned_rows(spark, sf_dir):
    return clean(bronze(spark, sf_dir))


def _meaningful(spark, sf_dir) -> DataFrame:
    return meaningful_rows(bronze(spark, sf_dir))


@query
def blank_rows_dropped(spark, sf_dir):
    return _meaningful(spark, sf_dir)


@query
def tat_swap(spark, sf_dir):
    return swap_reversed_dates(_meaningful(spark, sf_dir))


@query
def tat_recalc(spark, sf_dir):
    return recompute_negative(swap_reversed_dates(_meaningful(spark, sf_dir)))


@query
def tat_fill(spark, sf_dir):
    return validate_turnaround(_meaningful(spark, sf_dir))


# Identity ------------------------------------------------------------------------------------

def _resolved_numbers(spark, silver: DataFrame, sf_dir: str) -> DataFrame:
    return resolve_numbers(customers_by_number(silver), client(spark, sf_dir))


@query
def customer_columns(spark, sf_dir):
    return split_customers(to_silver(bronze(spark, sf_dir)))


@query
def complaint_columns(spark, sf_dir):
    return split_complaints(to_silver(bronze(spark, sf_dir)))


@query
def phone_to_profile(spark, sf_dir):
    return phone_lookup(client(spark, sf_dir))


def _with_profile(spark, sf_dir) -> DataFrame:
    complaints = split_complaints(stored_silver(spark, sf_dir, new_store(spark, "silver")))
    return attach_profile(complaints, phone_lookup(client(spark, sf_dir)))


@query
def complaints_with_profile(spark, sf_dir):
    return _with_profile(spark, sf_dir)


@query
def resolution_keys(spark, sf_dir):
    key = resolution_key(F.col("profileId"), F.col("number")).alias("resolution_key")
    return _with_profile(spark, sf_dir).select("number", "profileId", key).distinct()


@query
def identified_customers(spark, sf_dir):
    silver = stored_silver(spark, sf_dir, new_store(spark, "silver"))
    known = attach_profile(split_customers(silver), phone_lookup(client(spark, sf_dir)))
    return drop_unidentified(known, ["profileId", "number"])


@query
def keys_new_to_crosswalk(spark, sf_dir):
    silver = stored_silver(spark, sf_dir, new_store(spark, "silver"))
    earlier = _resolved_numbers(spark, silver.filter(is_earlier()), sf_dir)
    return new_keys(_resolved_numbers(spark, silver, sf_dir), crosswalk_of(earlier))


@query
def identity_map(spark, sf_dir):
    """Crosswalk after two runs: keys of the first keep the identifiers they got then."""
    store = new_store(spark, "crosswalk")
    silver = stored_silver(spark, sf_dir, store)
    earlier = _resolved_numbers(spark, silver.filter(is_earlier()), sf_dir)
    store.append(IDENTITY_MAP.name, crosswalk_of(earlier))
    known = store.read_appended(IDENTITY_MAP.name, IDENTITY_MAP.schema)
    numbers = _resolved_numbers(spark, silver, sf_dir)
    store.append(IDENTITY_MAP.name, extend_identity_map(numbers, known, SECOND_RUN_MILLIS))
    return store.read_appended(IDENTITY_MAP.name, IDENTITY_MAP.schema).select(
        "resolution_key", "customer_id", F.unix_millis("first_seen").alias("first_seen")
    )


@query
def minted_ids(spark, sf_dir):
    """Identifiers of a key set of its own: the phone numbers of all clients."""
    keys = client(spark, sf_dir).select(F.col("phoneNumber").alias("resolution_key"))
    return mint_ids(keys, RUN_MILLIS).select("resolution_key", "customer_id")


@query
def first_row_per_customer(spark, sf_dir):
    return gold(spark, sf_dir)[0]


@query
def complaints_of_customers(spark, sf_dir):
    return gold(spark, sf_dir)[1]


def _earlier_customers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All complaints, but the customers of the earlier sheets only."""
    store = new_store(spark, "orphans")
    silver = stored_silver(spark, sf_dir, store)
    customers, _ = stage(spark, silver.filter(is_earlier()), sf_dir, store)
    _, complaints = stage(spark, silver, sf_dir, store)
    return customers, complaints


@query
def orphan_filter(spark, sf_dir):
    customers, complaints = _earlier_customers(spark, sf_dir)
    return keep_known(complaints, customers, "customerId")


@query
def resolve_counts(spark, sf_dir):
    customers, complaints = gold(spark, sf_dir)
    total = complaints.agg(F.count(F.lit(1))).scalar()
    return customers.agg(F.count(F.lit(1)).alias("customers")).withColumn("complaints", total)


# Reports -------------------------------------------------------------------------------------

@query
def customer_overview(spark, sf_dir):
    return reports.customer_overview(*gold(spark, sf_dir))


@query
def complaint_summary(spark, sf_dir):
    return reports.complaint_summary(*gold(spark, sf_dir))


@query
def regional_stats(spark, sf_dir):
    return reports.regional_stats(gold(spark, sf_dir)[1])


@query
def status_share(spark, sf_dir):
    return reports.status_share(gold(spark, sf_dir)[1])


@query
def monthly_trends(spark, sf_dir):
    return reports.monthly_trends(gold(spark, sf_dir)[1])


def _kept_reports(spark, sf_dir) -> KeptReports:
    """Counts of the earlier complaints, to which the later ones are added; then every complaint of
    the second half of a month is removed and every open one revised."""
    complaints = gold(spark, sf_dir)[1]
    kept = KeptReports(new_store(spark, "kept"))
    kept.change(complaints.filter(f"logDate < '{SPLIT_DATE}'"))
    kept.change(complaints.filter(f"logDate >= '{SPLIT_DATE}'"))
    gone = F.dayofmonth("logDate") > 15
    revised = complaints.filter(~gone & (F.col("status") == "Closed"))
    kept.change(revised.withColumns({
        "status": F.lit("Resolved"), "region": F.lit("Volta Region"),
        "turnaroundTime": F.col("turnaroundTime") + 1, "natureOfComplaint": F.lit("Revised")}),
        complaints.filter(gone).unionByName(revised))
    return kept


@query
def monthly_trends_kept_up(spark, sf_dir):
    return _kept_reports(spark, sf_dir).monthly_trends()


@query
def monthly_summary_kept_up(spark, sf_dir):
    return _kept_reports(spark, sf_dir).monthly_summary()


@query
def regional_stats_kept_up(spark, sf_dir):
    return _kept_reports(spark, sf_dir).regional_stats()


@query
def monthly_summary_mv(spark, sf_dir):
    """The stored summary, refreshed by a second load."""
    store = new_store(spark, "summary")
    silver = stored_silver(spark, sf_dir, store)
    load_gold(store, *stage(spark, silver.filter(is_earlier()), sf_dir, store))
    refresh_summary(store)
    load_gold(store, *stage(spark, silver, sf_dir, store))
    refresh_summary(store)
    return store.read(SUMMARY)


def _orders_as_complaints(spark, sf_dir) -> DataFrame:
    """Orders in the shape of complaints: whole table, no cleaning in between."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customerId"),
        F.col("o_orderpriority").alias("natureOfComplaint"),
        F.col("o_orderpriority").alias("region"),
        F.when(F.col("o_orderstatus") == "F", "Resolved").otherwise(F.col("o_orderstatus"))
        .alias("status"),
        (F.col("o_orderkey") % 100).cast("int").alias("turnaroundTime"),
        F.col("o_orderdate").cast("date").alias("logDate"),
    )


@query
def regional_stats_of_orders(spark, sf_dir):
    return reports.regional_stats(_orders_as_complaints(spark, sf_dir))


@query
def status_share_of_orders(spark, sf_dir):
    return reports.status_share(_orders_as_complaints(spark, sf_dir))


@query
def monthly_trends_of_orders(spark, sf_dir):
    return reports.monthly_trends(_orders_as_complaints(spark, sf_dir))


@query
def overview_of_order_customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customerId"),
        F.col("c_mktsegment").alias("profileId"), F.col("c_name").alias("name"),
        F.lit("n").alias("number"), F.lit("n2").alias("number2"), F.lit("g").alias("gender"),
        F.lit(None).cast("date").alias("dateOfBirth"), F.lit("a").alias("accountType"),
        F.lit("b").alias("branch"),
    )
    return reports.customer_overview(customers, _orders_as_complaints(spark, sf_dir)).select(
        "customerId", "profileId", "name", "totalComplaints", "firstComplaintDate",
        "lastComplaintDate",
    )


# Quality and constraints ---------------------------------------------------------------------

@query
def dq_row_drop(spark, sf_dir):
    before = bronze(spark, sf_dir)
    return quality.row_drop(before, to_silver(before), "silver")


@query
def dq_nulls(spark, sf_dir):
    """Before cleaning there are nulls to find; after it there are none."""
    before = rename_headers(bronze(spark, sf_dir))
    after = to_silver(bronze(spark, sf_dir))
    return quality.unexpected_nulls(before, "bronze", ALWAYS_FILLED).unionByName(
        quality.unexpected_nulls(after, "silver", ALWAYS_FILLED)
    )


@query
def dq_duplicate_keys(spark, sf_dir):
    """Complaints repeat customers, customers do not."""
    customers, complaints = gold(spark, sf_dir)
    return quality.duplicate_keys(customers, "customers", "customerId").unionByName(
        quality.duplicate_keys(complaints, "complaints", "customerId")
    )


@query
def dq_orphans(spark, sf_dir):
    customers, complaints = _earlier_customers(spark, sf_dir)
    return quality.orphans(complaints, "complaints", "customerId", customers)


@query
def dq_empty(spark, sf_dir):
    customers, complaints = gold(spark, sf_dir)
    return quality.empty_table(customers, "customers").unionByName(
        quality.empty_table(complaints, "complaints")
    )


@query
def dq_ambiguous_phones(spark, sf_dir):
    """The client table as it is, and with every client under its region's number."""
    people = client(spark, sf_dir)
    shared = people.withColumn("phoneNumber", F.col("region"))
    return quality.ambiguous_phones(people).unionByName(quality.ambiguous_phones(shared))


@query
def dq_shared_phones(spark, sf_dir):
    return quality.shared_phones(client(spark, sf_dir))


@query
def dq_lost_turnaround(spark, sf_dir):
    return quality.lost_values(bronze(spark, sf_dir), "bronze", "TAT", to_int)


@query
def ck_crosswalk(spark, sf_dir):
    """The crosswalk of a first run, with one identifier for all."""
    silver = stored_silver(spark, sf_dir, new_store(spark, "silver"))
    numbers = resolve_numbers(customers_by_number(silver), client(spark, sf_dir))
    return violations(crosswalk_of(numbers).withColumn("customer_id", F.lit("same")),
                      IDENTITY_MAP, {})


@query
def ck_log(spark, sf_dir):
    """Log rows that lack their hash and come from a file with too long a name."""
    rows = fingerprint_log(bronze(spark, sf_dir), "x" * 256, "bronze", RUN_MILLIS)
    return violations(rows.withColumn("content_hash", F.lit(None).cast("string")),
                      INGESTION_LOG, {})


@query
def gold_ids(spark, sf_dir):
    """Every complaint of a load has an identifier of its own."""
    store = new_store(spark, "gold")
    load_gold(store, *stage(spark, stored_silver(spark, sf_dir, store), sf_dir, store))
    return store.read("complaints").agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("filled"),
        F.count_distinct("id").alias("distinct_ids"))


@query
def ck_not_null(spark, sf_dir):
    silver = stored_silver(spark, sf_dir, new_store(spark, "silver"))
    return column_violations(split_customers(silver), CUSTOMERS, ["not null"]).unionByName(
        column_violations(split_complaints(silver), COMPLAINTS, ["not null"])
    )


@query
def ck_length(spark, sf_dir):
    """Declared lengths of the client table, and tighter ones that some values exceed."""
    people = client(spark, sf_dir)
    tight = Table("tight", (
        DeclaredColumn("phoneNumber2", T.StringType(), max_length=12),
        DeclaredColumn("region", T.StringType(), max_length=12),
    ))
    return column_violations(people, CLIENT, ["length"]).unionByName(
        column_violations(people, tight, ["length"])
    )


@query
def ck_unique(spark, sf_dir):
    """Declared keys of the client table, and a column that is no key."""
    people = client(spark, sf_dir)
    loose = Table("loose", CLIENT.columns, unique=(("region",), ("region", "gender")))
    return unique_violations(people, CLIENT).unionByName(unique_violations(people, loose))


@query
def ck_foreign_key(spark, sf_dir):
    customers, complaints = _earlier_customers(spark, sf_dir)
    return foreign_key_violations(complaints, COMPLAINTS, {"customers": customers})
