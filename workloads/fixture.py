"""Complaint sheets and a client table derived from the given ``orders`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.joins import lookup_join
from caseloom.plans.schema import REGIONS
from caseloom.session import stored
from caseloom.sources.sheets import spread_scan

# The same expression text serves Spark and the check engine; only identifier quotes differ.
SHEET = """'S' || cast(year(o_orderdate)*100+month(o_orderdate) as varchar(6))"""
COLUMNS = {
    "NAME": """case when o_orderkey%41=0 then ' NaN ' when o_orderkey%41=1 then null
        else '  ' || lower(c_name) || ' ' end""",
    "GENDER": "case when o_custkey%2=0 then 'male' else 'FEMALE' end",
    "NUMBER": """case o_orderkey%6 when 0 then '0' || d
        when 1 then '0' || substr(d,1,2) || ' ' || substr(d,3,3) || ' ' || substr(d,6,4)
        when 2 then '233' || d when 3 then d when 4 then '+233' || d
        else case when o_orderkey%30=5 then '123' when o_orderkey%30=11 then null
        else '0' || d end end""",
    "NUMBER2": "case when o_orderkey%7=0 then '0' || d end",
    "ACCOUNT TYPE": """case c_mktsegment when 'BUILDING' then 'savings'
        when 'FURNITURE' then 'mobile wallet' else 'CURRENT' end""",
    "BRANCH": "'Branch ' || cast(o_custkey%7 as varchar(4))",
    "LOCATION": "'town ' || cast(o_orderkey%7 as varchar(4))",
    "REGION": """case o_orderkey%25 when 0 then lower(rname) when 1 then replace(rname,' Region','')
        when 2 then null when 3 then 'Xy Region' when 4 then 'Nowhere' when 5 then '  '
        else rname end""",
    "LOG DATE": """case when o_orderkey%45=7 then cast(o_orderdate as date)+3
        else cast(o_orderdate as date) end""",
    "COMPLAINT SOURCE": """case o_orderkey%3 when 0 then 'walk-in' when 1 then 'USSD'
        else 'phone call' end""",
    "NATURE OF COMPLAINT": "lower(o_orderpriority)",
    "SUBJECT": "upper(o_orderpriority)",
    "DETAILS OF COMPLAINT": "'charged twice, wants the second one back.'",
    "COMMENT": "case when o_orderkey%10<3 then '' else 'called back' end",
    "UPDATES": "case when o_orderkey%2=0 then '' else 'sent on' end",
    "STATUS": """case o_orderstatus when 'F' then 'RESOLVED' when 'O' then ' closed'
        else 'pending company' end""",
    "TAT": """case when o_orderkey%45=7 then '-3' when o_orderkey%45=8 then '-1'
        when o_orderkey%45=9 then null when o_orderkey%45=10 then 'n/a'
        when o_orderkey%45=11 then '3.0' when o_orderkey%45=12 then '1.5'
        else cast(o_orderkey%4 as varchar(4)) end""",
    "RESOLUTION DATE": """case when o_orderstatus='P' and o_orderkey%2=0 then null
        when o_orderkey%45=7 then cast(o_orderdate as date)
        else cast(o_orderdate as date)+cast(o_orderkey%4 as int) end""",
    "REASON FOR REVERSAL REQUEST": "case when o_orderkey%10=0 then 'paid two times' end",
    "ASSIGN": "'rep ' || cast(o_orderkey%5 as varchar(4))",
    "NAME OF CC REP": "'rep ' || cast(o_orderkey%3 as varchar(4))",
    "DOB": """case o_orderkey%18 when 0 then 'N/A' when 9 then 'N/A' when 1 then null
        when 2 then '-' when 3 then '3/7/1988' when 4 then '5-Jan-1990' when 5 then '8 Feb 1991'
        when 6 then '7 January 1992' when 7 then 'January 9, 1993' when 8 then '1985-03-10 junk'
        when 10 then '1985-03-10Tzzz'
        else cast(date '1960-01-01' + cast((o_custkey*37)%16000 as int) as varchar(10)) end""",
}
DIGITS = "cast(200000000+(o_custkey*7919)%400000000 as varchar(9))"
COPY_OFFSET = 1_000_000_000

CLIENT = {
    "profileId": "lpad(cast((c_custkey*48271)%1000000007 as varchar(10)),9,'0')",
    "accountHolderName": "c_name",
    "gender": "case c_custkey%3 when 0 then 'Male' when 1 then 'Female' else 'Other' end",
    "phoneNumber": """case when c_custkey%10<6
        then '+233' || cast(200000000+(c_custkey*7919)%400000000 as varchar(9))
        else '+233' || cast(600000000+c_custkey as varchar(9)) end""",
    "phoneNumber2": """case when c_custkey%10=6
        then '+233' || cast(200000000+(c_custkey*7919)%400000000 as varchar(9))
        when c_custkey%7=0 then '+233' || cast(700000000+c_custkey as varchar(9)) end""",
    "region": """case c_custkey%3 when 0 then 'Ashanti Region' when 1 then 'Volta Region'
        else 'Oti Region' end""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets as delivered: typed dates, messy text, exact copies and a blank row per sheet."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    names = F.array(*[F.lit(r) for r in REGIONS])
    # Stored, as the sheets, their regions and their rows are read by jobs of their own.
    placed = stored(lookup_join(orders, customer, "o_custkey", "inner"), "orders-of-customers")
    joined = (
        spread_scan(placed, "o_orderkey", tasks_per_core=4)
        .withColumn("d", F.expr(DIGITS))
        .withColumn("rname", F.element_at(names, (F.col("o_custkey") % 16 + 1).cast("int")))
    )
    copies = F.when(F.col("o_orderkey") % 50 == 3, F.array(F.lit(0), F.lit(COPY_OFFSET)))
    filled = joined.select(
        F.expr(SHEET).alias("sheet"),
        F.explode(F.coalesce(copies, F.array(F.lit(0)))).alias("copy"),
        "o_orderkey",
        *[F.expr(text).alias(name) for name, text in COLUMNS.items()],
    ).select("sheet", (F.col("o_orderkey") + F.col("copy")).alias("row_idx"), *COLUMNS)
    sheets = placed.select(F.expr(SHEET).alias("sheet")).distinct()
    blank = sheets.withColumn("row_idx", F.lit(-1).cast("long"))
    return filled.unionByName(blank, allowMissingColumns=True)


def client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        *[F.expr(text).alias(name) for name, text in CLIENT.items()]
    )
