"""The checks: each query again as SQL for an independent engine, over the given tables."""

from __future__ import annotations

from caseloom.plans.schema import REGIONS
from workloads import fixture
from workloads.parameters import RUN_MILLIS, SECOND_RUN_MILLIS, SOURCE_FILE, SPLIT_SHEET

RAW_COLUMNS = list(fixture.COLUMNS)
# Expected names, written out here so that the check does not take them from the code.
SILVER_COLUMNS = (
    "name gender number number2 accountType branch location region logDate complaintSource "
    "natureOfComplaint subject detailsOfComplaint comment updates status turnaroundTime "
    "resolutionDate reasonForReversalRequest assign nameOfCcRep dateOfBirth"
).split()
CAMEL = dict(zip(RAW_COLUMNS, SILVER_COLUMNS, strict=True))
_OF_CUSTOMER = ["name", "gender", "dateOfBirth", "accountType", "branch"]
CUSTOMER_COLUMNS = ["number", *_OF_CUSTOMER]
COMPLAINT_COLUMNS = ["number", *[c for c in SILVER_COLUMNS
                                 if c not in ("number", "number2", *_OF_CUSTOMER)]]
CUSTOMER_TABLE = ["customerId", "profileId", "number", "number2", *_OF_CUSTOMER]
COMPLAINT_TABLE = ["customerId", "profileId", "number", "number2", *COMPLAINT_COLUMNS[1:]]
UNTITLED = {"number", "number2", "branch"}
DATES = {"logDate", "resolutionDate", "dateOfBirth"}


def _q(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all(lower({x}), "
        rf"'[\p{{L}}]+|[^\p{{L}}]+'), "
        rf"lambda p: case p[1] when 'ß' then 'Ss' else upper(p[1]) end || p[2:]), '')"
    )


def _name(x: str) -> str:
    return (
        f"case when {x} is null or lower({_strip(x)}) in ('nan','none','null','') "
        f"then 'Unknown' else {_strip(x)} end"
    )


def _int(x: str) -> str:
    v = f"try_cast(trim({x}) as double)"
    return f"case when {v} = floor({v}) then cast({v} as integer) end"


def _date(x: str) -> str:
    v = _strip(x)
    forms = "'%m/%d/%Y', '%d-%b-%Y', '%d %b %Y', '%d %B %Y', '%B %d, %Y'"
    return (f"coalesce(case when regexp_full_match({v}, '[0-9]+-[0-9]+-[0-9]+') "
            f"then try_cast({v} as date) end, cast(try_strptime({v}, [{forms}]) as date))")


def _phone(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"case when length({d}) = 10 and {d} like '0%' then '+233' || substr({d}, 2) "
        f"when length({d}) = 12 and {d} like '233%' then '+' || {d} "
        f"when length({d}) = 9 then '+233' || {d} end"
    )


def _percent(part: str, whole: str) -> str:
    return f"cast((({part}) * 20000 + ({whole})) // (2 * ({whole})) as double) / 100.0"


def _month(m: str) -> str:
    return f"rpad(strftime({m}, '%B'), 9, ' ') || ' ' || strftime({m}, '%Y')"


def _base32(value: str, width: int) -> str:
    digit = "substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', (({v} >> {s}) & 31)::integer + 1, 1)"
    return " || ".join(
        digit.format(v=value, s=5 * i) for i in reversed(range(width))
    )


def _id(key: str, millis: int) -> str:
    first = f"('0x' || substr(sha256({key}), 1, 10))::bigint"
    second = f"('0x' || substr(sha256({key}), 11, 10))::bigint"
    return f"{_base32(f'{millis}::bigint', 10)} || {_base32(first, 8)} || {_base32(second, 8)}"


_REGION_ROWS = ", ".join(f"({i}, '{r}')" for i, r in enumerate(REGIONS))

RAW = f"""
raw as (
  with v(rid, rname) as (values {_REGION_ROWS}),
  t as (select o.*, c.*, {fixture.DIGITS} as d from orders o join customer c
        on o_custkey = c_custkey),
  base as (select {fixture.SHEET} as sheet, o_orderkey as row_idx,
    {", ".join(f'{text} as "{name}"' for name, text in fixture.COLUMNS.items())}
    from t join v on t.c_custkey % 16 = v.rid)
  select * from base
  union all select * replace (row_idx + {fixture.COPY_OFFSET} as row_idx)
    from base where row_idx % 50 = 3
  union all select sheet, -1, {", ".join("null" for _ in RAW_COLUMNS)}
    from (select distinct sheet from base))"""
CLIENT = f"""
client as (select {", ".join(f'{t} as "{n}"' for n, t in fixture.CLIENT.items())} from customer)"""
BRONZE = f"""
bronze as (select sheet, row_idx,
  {", ".join(f'cast("{c}" as varchar) as "{c}"' for c in RAW_COLUMNS)} from raw)"""


def _standard(column: str) -> str:
    name, x = CAMEL[column], f'"{column}"'
    if name == "name":
        value = _title(_name(x))
    elif name == "turnaroundTime":
        value = _int(x)
    elif name in DATES:
        value = _date(x)
    elif name == "number":
        value = _phone(x)
    elif name in UNTITLED:
        value = _strip(x)
    else:
        value = _title(_strip(x))
    return f'{value} as "{name}"'


STANDARD = f"""
standard as (select sheet, row_idx, {", ".join(_standard(c) for c in RAW_COLUMNS)} from bronze)"""


def _best_region(values: str) -> str:
    """CTEs ending in best_region(v, choice): token-set ratio by dynamic programming."""
    return f"""
choices(pos, choice) as (values {_REGION_ROWS}),
variants as ({values}),
tokens as (select v, pos, choice,
    list_distinct(list_filter(string_split_regex(v, '\\s+'), lambda w: w <> '')) as x,
    list_distinct(string_split(choice, ' ')) as y from variants, choices),
parts as (select v, pos, choice, len(x) as nx,
    array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') as s,
    array_to_string(list_sort(list_filter(x, lambda w: not list_contains(y, w))), ' ') as a,
    array_to_string(list_sort(list_filter(y, lambda w: not list_contains(x, w))), ' ') as b
    from tokens),
lcs(a, b, i, r) as (
    select distinct a, b, 0::bigint, list_transform(range(length(b) + 1), lambda k: 0::bigint)
    from parts
    union all
    select a, b, i + 1, list_transform(range(length(b) + 1), lambda j: list_max(
        list_transform(range(j + 1), lambda k: case
            when k > 0 and substr(b, k, 1) = substr(a, i + 1, 1) then r[k] + 1
            else r[k + 1] end)))
    from lcs where i < length(a)),
distances as (select p.*, length(s) as ls, least(length(s), 1) as g, length(p.a) as la,
    length(p.b) as lb, length(p.a) + length(p.b) - 2 * r[length(p.b) + 1] as dist
    from parts p join lcs on p.a = lcs.a and p.b = lcs.b and lcs.i = length(p.a)),
scores as (select v, pos, choice, case
    when nx = 0 then 0.0::double
    when ls > 0 and (la = 0 or lb = 0) then 100.0::double
    else greatest(
        100.0::double - 100.0::double * dist / (2 * (ls + g) + la + lb),
        case when ls > 0 then 100.0::double - 100.0::double * (g + la) / (ls + ls + g + la)
            else 0 end,
        case when ls > 0 then 100.0::double - 100.0::double * (g + lb) / (ls + ls + g + lb)
            else 0 end) end as score from distances),
best_region as (select v, arg_max(choice, score * 100000000 - pos) as choice from
    (select * from scores where score >= 80) group by v)"""


REGION = _best_region(
    "select distinct region as v from standard where region is not null and region <> ''"
)
CANONICAL = """
canonical as (select standard.* replace (coalesce(choice, 'Unknown') as region)
  from standard left join best_region on region = v)"""
DISTINCT = f"""
cleaned as (select * from canonical qualify
  row_number() over (partition by {_q(SILVER_COLUMNS)} order by sheet, row_idx) = 1)"""
MEANINGFUL = f"""
meaningful as (select * from cleaned where coalesce(
  {", ".join(f'cast("{c}" as varchar)' for c in SILVER_COLUMNS if c not in ("name", "region"))})
  is not null)"""
SWAPPED = """
swapped as (select * replace (
    case when fix then "resolutionDate" else "logDate" end as "logDate",
    case when fix then "logDate" else "resolutionDate" end as "resolutionDate",
    case when fix then cast("logDate" - "resolutionDate" as integer) else "turnaroundTime" end
      as "turnaroundTime")
  from (select *, coalesce("turnaroundTime" < 0 and "logDate" > "resolutionDate", false) as fix
        from meaningful)),
swap_only as (select * exclude (fix) from swapped)"""
RECALCULATED = """
recalculated as (select * replace (
    case when "turnaroundTime" < 0 and "resolutionDate" >= "logDate"
      then cast("resolutionDate" - "logDate" as integer) else "turnaroundTime" end
      as "turnaroundTime") from swap_only)"""
SILVER = """
silver as (select * replace (
    case when "turnaroundTime" is null and "resolutionDate" >= "logDate"
      then cast("resolutionDate" - "logDate" as integer) else "turnaroundTime" end
      as "turnaroundTime") from recalculated)"""
CLEANING = [RAW, BRONZE, STANDARD, REGION, CANONICAL, DISTINCT, MEANINGFUL, SWAPPED,
            RECALCULATED, SILVER]

LOOKUP = """
lookup as (select number, "profileId", number2 from (
    select "phoneNumber" as number, "profileId", "phoneNumber2" as number2, 0 as prio from client
    union all select "phoneNumber2", "profileId", "phoneNumber2", 1 from client)
  where number is not null
  qualify row_number() over (partition by number order by prio, "profileId") = 1)"""


def _resolved(crosswalk: str) -> str:
    return f"""
keyed as (select silver.* exclude (number2), "profileId", lookup.number2,
    coalesce("profileId", 'number:' || silver.number) as resolution_key
  from silver left join lookup on silver.number = lookup.number),
crosswalk as ({crosswalk}),
identified as (select keyed.*, customer_id as "customerId" from keyed
  join crosswalk on keyed.resolution_key = crosswalk.resolution_key),
customers as (select {_q(CUSTOMER_TABLE)} from identified
  qualify row_number() over (partition by "customerId" order by sheet, row_idx) = 1),
complaints as (select {_q(COMPLAINT_TABLE)} from identified)"""


NEW_CROSSWALK = f"""select distinct resolution_key, {_id("resolution_key", RUN_MILLIS)}
  as customer_id from keyed where resolution_key is not null"""
RESOLVED = [*CLEANING, CLIENT, LOOKUP, _resolved(NEW_CROSSWALK)]
# The crosswalk of a first run over the earlier sheets only, extended by a second over all.
EARLIER_KEYS = f"""earlier_keys as (select distinct resolution_key from keyed
  where sheet < '{SPLIT_SHEET}' and resolution_key is not null)"""
TWO_RUN_CROSSWALK = f"""
  with {EARLIER_KEYS}
  select distinct keyed.resolution_key, case when e.resolution_key is not null
    then {_id("keyed.resolution_key", RUN_MILLIS)}
    else {_id("keyed.resolution_key", SECOND_RUN_MILLIS)} end as customer_id
  from keyed left join earlier_keys e on keyed.resolution_key = e.resolution_key
  where keyed.resolution_key is not null"""


def _with(ctes: list[str], query: str) -> str:
    if query.lstrip().startswith("with"):
        query = f"select * from ({query})"
    return f"with recursive {','.join(ctes)}\n{query}"


def _hash_rows(columns: list[str]) -> str:
    parts = ", ".join(
        f"""'{c}:' || cast(length("{c}") as varchar) || '=' || "{c}" """ for c in sorted(columns)
    )
    return f"sha256(concat_ws('|', cast(row_idx as varchar), {parts}))"


def _fingerprints(source: str) -> str:
    lanes = ", ".join(
        f"bit_xor(('0x' || substr(h, {1 + 15 * i}, 15))::bigint) as x{i}" for i in range(4)
    )
    return f"""(select sheet, sha256(concat_ws(':', cast(n as varchar),
      {", ".join(f"cast(x{i} as varchar)" for i in range(4))})) as content_hash, n as row_count
      from (select sheet, count(*) as n, {lanes}
            from (select sheet, {_hash_rows(RAW_COLUMNS)} as h from {source}) group by sheet))"""


def _long(table: str, rule: str, columns: dict[str, str], source: str) -> str:
    return " union all ".join(
        f"""select '{table}' as "table", '{rule}' as "rule", '{c}' as "columns",
        cast(coalesce({count}, 0) as bigint) as violations from {source}"""
        for c, count in columns.items()
    )


def _finding(check: str, table: str, metric: str, threshold: float, source: str = "") -> str:
    return f"""select '{check}' as "check", '{table}' as "table", metric,
      {threshold}::double as threshold, metric <= {threshold} as passed
      from (select cast({metric} as double) as metric {source})"""


def _share(condition: str) -> str:
    return _percent(f"count(*) filter ({condition})", "count(*)")


_STORY = ["logDate", "complaintSource", "natureOfComplaint", "subject", "detailsOfComplaint",
          "status", "resolutionDate", "turnaroundTime", "location", "region", "updates", "comment",
          "reasonForReversalRequest"]
_OF_MONTH = f"""select mm, {_month("mm")} as month, mm as "monthStart", count(*) as "totalComplaints",
    count(distinct "customerId") as "uniqueCustomers", avg("turnaroundTime") as "avgTurnaroundTime"
  from dated group by mm"""
_DATED = """dated as (select *, cast(date_trunc('month', "logDate") as date) as mm from complaints
  where "logDate" is not null)"""


def _top(column: str, name: str) -> str:
    return f"""(select mm, {column} as "{name}" from dated where {column} is not null
      group by mm, {column}
      qualify row_number() over (partition by mm order by count(*) desc, {column}) = 1)"""


REPORTS = {
    "customer_overview": f"""with per_customer as (
          select "customerId", count(*) as n, min("logDate") as low, max("logDate") as high
          from complaints group by all)
        select {_q(CUSTOMER_TABLE)}, coalesce(n, 0) as "totalComplaints",
          low as "firstComplaintDate", high as "lastComplaintDate"
        from customers left join per_customer using ("customerId")""",
    "complaint_summary": f"""with people as (select "customerId", name, number from customers),
        told as (select "customerId", "profileId", {_q(_STORY)} from complaints)
        select "customerId", name, number, "profileId", {_q(_STORY)},
          case when "turnaroundTime" > 72 or "turnaroundTime" is null then 'Over 3 days'
               when "turnaroundTime" > 24 then 'Within 3 days' else 'Within 1 day' end
            as "turnaroundCategory"
        from people join told using ("customerId")""",
    "regional_stats": f"""select region, count(*) as "totalComplaints",
          count(distinct "customerId") as "uniqueCustomers",
          avg("turnaroundTime") as "avgTurnaroundTime",
          count(*) filter (status = 'Resolved') as "resolvedCount",
          {_share("status = 'Resolved'")} as "resolutionRate"
        from complaints where coalesce(region, 'Unknown') <> 'Unknown' group by region""",
    "status_share": f"""with per_status as (
          select status, count(*) as n, avg("turnaroundTime") as mean, min("logDate") as low,
            max("logDate") as high from complaints group by all)
        select status, n as "complaintCount", {_percent("n", "sum(n) over ()")} as percentage,
          mean as "avgTurnaroundTime", low as "oldestComplaint", high as "newestComplaint"
        from per_status""",
    "monthly_trends": f"""with {_DATED}, per_month as ({_OF_MONTH})
        select per_month.* exclude (mm), "topComplaintType", "topRegion" from per_month
        left join {_top('"natureOfComplaint"', "topComplaintType")} using (mm)
        left join {_top("region", "topRegion")} using (mm)""",
    "monthly_summary_mv": f"""with {_DATED}, per_month as ({_OF_MONTH})
        select * exclude (mm) from per_month""",
}
