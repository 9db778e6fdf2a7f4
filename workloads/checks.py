"""SQL checks by query name."""

from __future__ import annotations

from workloads.oracle import (
    BRONZE, CAMEL, CLEANING, CLIENT, COMPLAINT_COLUMNS, COMPLAINT_TABLE, CUSTOMER_COLUMNS,
    CUSTOMER_TABLE, LOOKUP, MEANINGFUL, CANONICAL, DISTINCT, RAW, RAW_COLUMNS,
    RECALCULATED, REGION, REPORTS, RESOLVED, STANDARD, SWAPPED, TWO_RUN_CROSSWALK, EARLIER_KEYS,
    _date, _fingerprints, _finding, _id, _int, _long, _name, _percent, _phone, _q, _resolved, _strip,
    _title, _with, _best_region,
)
from workloads.parameters import (
    EXCLUDED_SHEET, RUN_MILLIS, SECOND_RUN_MILLIS, SOURCE_FILE, SPLIT_SHEET,
)

_BRONZE = [RAW, BRONZE]
_TO_CLEANED = [*_BRONZE, STANDARD, REGION, CANONICAL, DISTINCT]
_PROFILE = [*CLEANING, CLIENT, LOOKUP]
_PROFILED = f"""(select silver.* exclude (number2), lookup."profileId", lookup.number2
  from silver left join lookup on silver.number = lookup.number)"""
_EARLIER = f"sheet < '{SPLIT_SHEET}'"


def _first_customers(condition: str) -> str:
    return f"""(select {_q(CUSTOMER_TABLE)} from identified where {condition}
      qualify row_number() over (partition by "customerId" order by sheet, row_idx) = 1)"""


_EARLIER_CUSTOMERS = f"""earlier_customers as (select * from {_first_customers(_EARLIER)}),
later_customers as (select * from {_first_customers(f"not {_EARLIER}")})"""
_ORDERS = """
complaints as (select cast(o_custkey as varchar) as "customerId",
  o_orderpriority as "natureOfComplaint", o_orderpriority as region,
  case when o_orderstatus = 'F' then 'Resolved' else o_orderstatus end as status,
  cast(o_orderkey % 100 as integer) as "turnaroundTime",
  cast(o_orderdate as date) as "logDate" from orders)"""

_CHANGED = """changed as (select * replace (
    case when status = 'Closed' then 'Volta Region' else region end as region,
    case when status = 'Closed' then "turnaroundTime" + 1 else "turnaroundTime" end as "turnaroundTime",
    case when status = 'Closed' then 'Revised' else "natureOfComplaint" end as "natureOfComplaint",
    case when status = 'Closed' then 'Resolved' else status end as status)
  from complaints where day("logDate") <= 15)"""


def _of_changed(report: str) -> str:
    return _with([*RESOLVED, _CHANGED], REPORTS[report].replace("from complaints", "from changed"))


CHECKS: dict[str, str] = {
    # Sources and sinks
    "scan_csv_sheets": _with(_BRONZE, "select * from bronze"),
    "scan_numbered_csv": _with(_BRONZE, """select * replace (
        row_number() over (partition by sheet order by row_idx) - 1 as row_idx) from bronze"""),
    "scan_mixed_headers": _with(_BRONZE, """select * replace (
        case when row_idx % 2 = 0 then "DOB" end as "DOB") from bronze"""),
    "scan_mixed_types": _with(_BRONZE, """select * replace (
        case when row_idx % 2 = 0 then (case when regexp_full_match("TAT", '-?[0-9]+') then "TAT" end) else "TAT" end
          as "TAT",
        case when row_idx % 2 <> 0 then "UPDATES" end as "UPDATES") from bronze"""),
    "scan_multiline_cells": _with(_BRONZE, """select * replace (
        'said "' || "STATUS" || '",' || chr(10) || chr(10) || 'then' || chr(13) || chr(10) || 'rang'
          as "DETAILS OF COMPLAINT") from bronze"""),
    "scan_large_csv": _with(_BRONZE, """select * exclude (sheet, row_idx) replace (
        'said "' || "STATUS" || '",' || chr(10) || chr(10) || 'then' || chr(13) || chr(10) || 'rang'
          as "DETAILS OF COMPLAINT"), sheet as "ORIGIN", row_idx::varchar as "PLACE", 'ALL' as sheet,
        row_number() over (order by sheet, row_idx) - 1 as row_idx from bronze"""),
    "empty_sheets_skipped": _with(_BRONZE, """select sheet, count(*) as n,
        0::bigint as rows_of_empty, 0::bigint as changed_in_empty from bronze group by sheet"""),
    "exclude_sheets": _with(_BRONZE, f"select * from bronze where sheet <> '{EXCLUDED_SHEET}'"),
    "stringify_columns": _with(_BRONZE, "select * from bronze"),
    "land_bronze": _with(_BRONZE, f"""select * replace (
        case when {_EARLIER} then "UPDATES" else 'revised' end as "UPDATES") from bronze"""),
    "union_by_name": _with(_BRONZE, f"""
        select * exclude ("NUMBER2", "DOB") from bronze where {_EARLIER}
        union all by name select * exclude ("UPDATES") from bronze where not {_EARLIER}"""),
    "silver_table": _with(CLEANING, "select * from silver"),
    "silver_from_changes": _with(CLEANING, "select * from silver"),
    "staging_replace": _with(CLEANING, f"select {_q(COMPLAINT_COLUMNS)} from silver"),
    "upsert_customers": _with([*RESOLVED, _EARLIER_CUSTOMERS], """
        select * from later_customers union all select * from earlier_customers
        where "customerId" not in (select "customerId" from later_customers)"""),
    "upsert_touched_parts": _with([*RESOLVED, f"""parted as (select *, lpad(
          (('0x' || substr(md5("customerId"), 1, 8))::bigint % 256)::varchar, 6, '0') as part from identified),
        early as (select {_q(CUSTOMER_TABLE)}, part from parted where sheet < (select max(sheet) from parted)
          qualify row_number() over (partition by "customerId" order by sheet, row_idx) = 1),
        late as (select {_q(CUSTOMER_TABLE)}, part from parted where sheet = (select max(sheet) from parted)
          qualify row_number() over (partition by "customerId" order by row_idx) = 1),
        merged as (select * from late union all select * from early
          where "customerId" not in (select "customerId" from late))"""],
        "select *, part in (select part from late) as rewritten from merged"),
    "replace_complaints": _with(RESOLVED, f"""
        select {_q(COMPLAINT_TABLE)} from identified where not {_EARLIER}"""),
    "gold_load_counts": _with([*RESOLVED, _EARLIER_CUSTOMERS], f"""
        select (select count(*) from later_customers) as customers,
        (select count(*) from identified where not {_EARLIER}) as complaints"""),
    "insert_absent_keys": _with(
        [*_PROFILE, _resolved(TWO_RUN_CROSSWALK)],
        "select resolution_key, customer_id from crosswalk",
    ),
    "registered_views": _with(RESOLVED, REPORTS["status_share"]),
    # Change detection
    "sheet_fingerprint": _with(_BRONZE, f"select * from {_fingerprints('bronze')}"),
    "last_hash_per_key": """select user_id as sheet_name, event_type as source_file,
        props as content_hash from events qualify row_number() over (
        partition by user_id, event_type order by ts desc, props desc) = 1""",
    "changed_sheets_only": _with(_BRONZE, f"""
        select sheet as sheet_name, content_hash, row_count from {_fingerprints('bronze')}
        where not {_EARLIER} or sheet = '{EXCLUDED_SHEET}'"""),
    "log_ingestion": _with(_BRONZE, f"""
        select sheet as sheet_name, '{SOURCE_FILE}' as source_file, content_hash, row_count,
        'bronze/sheet=' || sheet as bronze_path, case when {_EARLIER} then {RUN_MILLIS}::bigint
          else {SECOND_RUN_MILLIS}::bigint end as processed_at
        from {_fingerprints('bronze')}"""),
    "unchanged_run": _with(_BRONZE, f"""
        select sheet as sheet_name, content_hash, row_count, 0::bigint as changed_in_second_run
        from {_fingerprints('bronze')}"""),
    # Cleaning
    "lower_camel_headers": _with(_BRONZE, f"""select sheet, row_idx,
        {", ".join(f'"{c}" as "{n}"' for c, n in CAMEL.items())} from bronze"""),
    "name_default": _with(_BRONZE, f"""
        select sheet, row_idx, {_name('"NAME"')} as name from bronze"""),
    "coerce_int": _with(_BRONZE, f"""
        select sheet, row_idx, {_int('"TAT"')} as "turnaroundTime" from bronze"""),
    "coerce_date": _with(_BRONZE, f"""select sheet, row_idx, {_date('"LOG DATE"')} as "logDate",
        {_date('"RESOLUTION DATE"')} as "resolutionDate", {_date('"DOB"')} as "dateOfBirth"
        from bronze"""),
    "day_difference": _with(_BRONZE, """select sheet, row_idx,
        cast(cast("RESOLUTION DATE" as date) - cast("LOG DATE" as date) as integer) as days
        from bronze"""),
    "trim_text": _with(_BRONZE, f"""select sheet, row_idx,
        {", ".join(f'''{_strip(f'"{c}"')} as "{n}"''' for c, n in CAMEL.items())} from bronze"""),
    "title_case_text": _with(_BRONZE, f"""select sheet, row_idx,
        {", ".join(f'''{_title(f'"{c}"')} as "{n}"''' for c, n in CAMEL.items())} from bronze"""),
    "title_case_documents": f"select doc_id, {_title('text')} as titled from documents",
    "fuzzy_region": _with(
        [*_BRONZE, f"""
        titled as (select sheet, row_idx, {_title(_strip('"REGION"'))} as region from bronze)""",
         _best_region("""select distinct region as v from titled
            where region is not null and region <> ''""")],
        """select sheet, row_idx, coalesce(choice, 'Unknown') as region
        from titled left join best_region on region = v"""),
    "phone_e164": _with(_BRONZE, f"""select sheet, row_idx, {_phone('"NUMBER"')} as number,
        {_phone('"NUMBER2"')} as number2 from bronze"""),
    "standard_values": _with([*_BRONZE, STANDARD], "select * from standard"),
    "distinct_cleaned_rows": _with(_TO_CLEANED, "select * from cleaned"),
    "blank_rows_dropped": _with([*_TO_CLEANED, MEANINGFUL], "select * from meaningful"),
    "tat_swap": _with([*_TO_CLEANED, MEANINGFUL, SWAPPED], "select * from swap_only"),
    "tat_recalc": _with(
        [*_TO_CLEANED, MEANINGFUL, SWAPPED, RECALCULATED], "select * from recalculated"),
    "tat_fill": _with(CLEANING, "select * from silver"),
    # Identity
    "customer_columns": _with(CLEANING, f"select distinct {_q(CUSTOMER_COLUMNS)} from silver"),
    "complaint_columns": _with(CLEANING, f"select {_q(COMPLAINT_COLUMNS)} from silver"),
    "phone_to_profile": _with([CLIENT, LOOKUP], "select * from lookup"),
    "complaints_with_profile": _with(_PROFILE, f"""
        select {_q(COMPLAINT_COLUMNS)}, "profileId", number2 from {_PROFILED}"""),
    "resolution_keys": _with(_PROFILE, f"""select distinct number, "profileId",
        coalesce("profileId", 'number:' || number) as resolution_key from {_PROFILED}"""),
    "identified_customers": _with(_PROFILE, f"""
        select distinct {_q(CUSTOMER_COLUMNS)}, "profileId", number2 from {_PROFILED}
        where "profileId" is not null or number is not null"""),
    "keys_new_to_crosswalk": _with([*RESOLVED, EARLIER_KEYS], """
        select resolution_key from keyed where resolution_key is not null
        except select resolution_key from earlier_keys"""),
    "identity_map": _with([*_PROFILE, _resolved(TWO_RUN_CROSSWALK), EARLIER_KEYS], f"""
        select resolution_key, customer_id, case when resolution_key in
          (select resolution_key from earlier_keys) then {RUN_MILLIS}::bigint
          else {SECOND_RUN_MILLIS}::bigint end as first_seen from crosswalk"""),
    "minted_ids": _with([CLIENT], f"""select "phoneNumber" as resolution_key,
        {_id('"phoneNumber"', RUN_MILLIS)} as customer_id from client"""),
    "first_row_per_customer": _with(RESOLVED, "select * from customers"),
    "complaints_of_customers": _with(RESOLVED, "select * from complaints"),
    "orphan_filter": _with([*RESOLVED, _EARLIER_CUSTOMERS], """select * from complaints
        where "customerId" in (select "customerId" from earlier_customers)"""),
    "resolve_counts": _with(RESOLVED, """select (select count(*) from customers) as customers,
        (select count(*) from complaints) as complaints"""),
    # Reports
    **{name: _with(RESOLVED, text) for name, text in REPORTS.items()},
    "regional_stats_kept_up": _of_changed("regional_stats"),
    "monthly_trends_kept_up": _of_changed("monthly_trends"),
    "monthly_summary_kept_up": _of_changed("monthly_summary_mv"),
    "regional_stats_of_orders": _with([_ORDERS], REPORTS["regional_stats"]),
    "status_share_of_orders": _with([_ORDERS], REPORTS["status_share"]),
    "monthly_trends_of_orders": _with([_ORDERS], REPORTS["monthly_trends"]),
    "overview_of_order_customers": """select cast(c_custkey as varchar) as "customerId",
        c_mktsegment as "profileId", c_name as name, count(o_orderkey) as "totalComplaints",
        cast(min(o_orderdate) as date) as "firstComplaintDate",
        cast(max(o_orderdate) as date) as "lastComplaintDate"
        from customer left join orders on c_custkey = o_custkey
        group by c_custkey, c_mktsegment, c_name""",
    # Quality and constraints
    "dq_row_drop": _with(CLEANING, _finding(
        "row drop percent", "silver",
        "(1.0 - (select count(*) from silver)::double / count(*)) * 100", 20, "from bronze")),
    "dq_nulls": _with(CLEANING, " union all ".join(
        _finding(f"nulls in {c}", t, f'count(*) filter ("{x}" is null)', 0, f"from {t}")
        for t, c, x in [("bronze", "name", "NAME"), ("bronze", "region", "REGION"),
                        ("silver", "name", "name"), ("silver", "region", "region")])),
    "dq_duplicate_keys": _with(RESOLVED, " union all ".join(
        _finding("duplicate customerId", t, 'count(*) - count(distinct "customerId")', 0,
                 f"from {t}") for t in ("customers", "complaints"))),
    "dq_orphans": _with([*RESOLVED, _EARLIER_CUSTOMERS], _finding(
        "orphan customerId", "complaints", "count(*)", 0, """from complaints
        where "customerId" not in (select "customerId" from earlier_customers)""")),
    "dq_empty": _with(RESOLVED, " union all ".join(
        _finding("empty", t, "case when count(*) = 0 then 1 else 0 end", 0, f"from {t}")
        for t in ("customers", "complaints"))),
    "dq_ambiguous_phones": _with([CLIENT], " union all ".join(
        _finding("shared phoneNumber", "client", "count(*)", 0, f"""from (select {c} from client
        where {c} is not null group by {c} having count(*) > 1)""")
        for c in ('"phoneNumber"', "region"))),
    "ck_not_null": _with(CLEANING, f"""
        {_long("customers", "not null", {
            "number": 'count(*) filter (number is null)',
            "name": 'count(*) filter (name is null)'},
            f"(select distinct {_q(CUSTOMER_COLUMNS)} from silver)")} union all
        {_long("complaints", "not null", {
            "number": 'count(*) filter (number is null)',
            "logDate": 'count(*) filter ("logDate" is null)'}, "silver")}"""),
    "ck_length": _with([CLIENT], f"""
        {_long("client", "length", {
            c: f'count(*) filter (length("{c}") > {n})' for c, n in [
                ("profileId", 50), ("accountHolderName", 150), ("gender", 20),
                ("phoneNumber", 20), ("phoneNumber2", 20), ("region", 50)]}, "client")} union all
        {_long("tight", "length", {
            c: f'count(*) filter (length("{c}") > 12)' for c in ("phoneNumber2", "region")},
            "client")}"""),
    "ck_unique": _with([CLIENT], f"""
        {_long("client", "unique", {
            "profileId": 'count("profileId") - count(distinct "profileId")'}, "client")}
        union all {_long("loose", "unique", {
            "region": "count(*) - count(distinct region)",
            "region, gender": "count(*) - count(distinct (region, gender))"}, "client")}"""),
    "dq_shared_phones": _with([CLIENT], _finding("shared phone number", "client", "count(*)", 0,
        """from (select n from (select "profileId" as p, "phoneNumber" as n from client
          union select "profileId", "phoneNumber2" from client) where n is not null
          group by n having count(distinct p) > 1)""")),
    "dq_lost_turnaround": _with(_BRONZE, _finding("values lost in TAT", "bronze",
        f"""count(*) filter (length({_strip('"TAT"')}) > 0 and ({_int('"TAT"')}) is null)""", 0,
        "from bronze")),
    "ck_crosswalk": _with(RESOLVED, " union all ".join([
        _long("customer_identity_map", "not null", {c: "0" for c in (
            "resolution_key", "customer_id", "first_seen")}, "(select 1)"),
        _long("customer_identity_map", "length", {c: "0" for c in (
            "resolution_key", "customer_id")}, "(select 1)"),
        _long("customer_identity_map", "unique", {
            "resolution_key": "0 * count(*)", "customer_id": 'count(distinct "customerId") - 1'},
            "complaints")])),
    "ck_log": _with(_BRONZE, " union all ".join([
        _long("ingestion_log", "not null", {
            "sheet_name": "0 * count(*)", "source_file": "0 * count(*)", "content_hash": "count(distinct sheet)",
            "row_count": "0 * count(*)", "bronze_path": "0 * count(*)", "processed_at": "0 * count(*)"}, "bronze"),
        _long("ingestion_log", "length", {
            "sheet_name": "0 * count(*)", "source_file": "count(distinct sheet)", "content_hash": "0 * count(*)",
            "bronze_path": "0 * count(*)"}, "bronze")])),
    "gold_ids": _with(RESOLVED, """select count(*) as n, count(*) as filled, count(*) as distinct_ids
        from complaints"""),
    "ck_foreign_key": _with([*RESOLVED, _EARLIER_CUSTOMERS], _long(
        "complaints", "foreign key", {"customerId": """count(*) filter ("customerId" not in
        (select "customerId" from earlier_customers))"""}, "complaints")),
}
