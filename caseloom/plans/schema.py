"""Columns, tables and their declared constraints."""

from __future__ import annotations

from pyspark.sql import types as T

from caseloom.operators.constraints import Column, ForeignKey, Table

LINEAGE = ("sheet", "row_idx")

# The reference list of regions, in the order in which ties are decided.
REGIONS = (
    "Ashanti Region", "Greater Accra Region", "Northern Region", "Volta Region",
    "Central Region", "Western Region", "Upper West Region", "Upper East Region",
    "Oti Region", "Savannah Region", "Bono East Region", "Western North Region",
    "Brong Ahafo Region", "North East Region", "Ahafo Region", "Eastern Region",
)
REGION_THRESHOLD = 80.0

# The short headers and their long names, and the columns and limits of the tables.
RENAMES = {"tat": "turnaroundTime", "dob": "dateOfBirth"}
DATE_COLUMNS = ("logDate", "resolutionDate", "dateOfBirth")
#: Text that keeps its case.
CASE_KEPT = ("number", "number2", "branch", "customerId", "profileId")
#: Columns that cleaning always fills, so they do not make a row meaningful.
ALWAYS_FILLED = ("name", "region")

CUSTOMERS = Table(
    "customers",
    (
        Column("customerId", T.StringType(), max_length=26, nullable=False),
        Column("profileId", T.StringType(), max_length=50),
        Column("number", T.StringType(), max_length=20, nullable=False),
        Column("number2", T.StringType(), max_length=20),
        Column("name", T.StringType(), max_length=150, nullable=False),
        Column("gender", T.StringType(), max_length=20),
        Column("dateOfBirth", T.DateType()),
        Column("accountType", T.StringType(), max_length=50),
        Column("branch", T.StringType(), max_length=100),
    ),
    unique=(("customerId",),),
)
COMPLAINTS = Table(
    "complaints",
    (
        Column("customerId", T.StringType(), max_length=26, nullable=False),
        Column("profileId", T.StringType(), max_length=50),
        Column("number", T.StringType(), max_length=20, nullable=False),
        Column("number2", T.StringType(), max_length=20),
        Column("location", T.StringType(), max_length=150),
        Column("region", T.StringType(), max_length=50),
        Column("logDate", T.DateType(), nullable=False),
        Column("complaintSource", T.StringType(), max_length=100),
        Column("natureOfComplaint", T.StringType(), max_length=150),
        Column("subject", T.StringType(), max_length=255),
        Column("detailsOfComplaint", T.StringType()),
        Column("comment", T.StringType()),
        Column("updates", T.StringType()),
        Column("status", T.StringType(), max_length=50),
        Column("turnaroundTime", T.IntegerType()),
        Column("resolutionDate", T.DateType()),
        Column("reasonForReversalRequest", T.StringType()),
        Column("assign", T.StringType(), max_length=100),
        Column("nameOfCcRep", T.StringType(), max_length=100),
    ),
    foreign_keys=(ForeignKey("customerId", "customers", "customerId"),),
)
#: What a silver row says itself; identity resolution adds the rest.
_RESOLVED = ("customerId", "profileId", "number2")
CUSTOMER_COLUMNS = tuple(c for c in CUSTOMERS.column_names if c not in _RESOLVED)
COMPLAINT_COLUMNS = tuple(c for c in COMPLAINTS.column_names if c not in _RESOLVED)

CLIENT = Table(
    "client",
    (
        Column("profileId", T.StringType(), max_length=50, nullable=False),
        Column("accountHolderName", T.StringType(), max_length=150),
        Column("gender", T.StringType(), max_length=20),
        Column("phoneNumber", T.StringType(), max_length=20),
        Column("phoneNumber2", T.StringType(), max_length=20),
        Column("region", T.StringType(), max_length=50),
    ),
    unique=(("profileId",),),
)
INGESTION_LOG = Table(
    "ingestion_log",
    (
        Column("sheet_name", T.StringType(), max_length=255, nullable=False),
        Column("source_file", T.StringType(), max_length=255, nullable=False),
        Column("content_hash", T.StringType(), max_length=64, nullable=False),
        Column("row_count", T.LongType(), nullable=False),
        Column("bronze_path", T.StringType(), max_length=500, nullable=False),
        Column("processed_at", T.TimestampType(), nullable=False),
    ),
)
IDENTITY_MAP = Table(
    "customer_identity_map",
    (
        Column("resolution_key", T.StringType(), max_length=100, nullable=False),
        Column("customer_id", T.StringType(), max_length=26, nullable=False),
        Column("first_seen", T.TimestampType(), nullable=False),
    ),
    unique=(("resolution_key",), ("customer_id",)),
)
