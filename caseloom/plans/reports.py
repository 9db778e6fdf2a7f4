"""Reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.coerce import rounded_percentage
from caseloom.operators.joins import lookup_join
from caseloom.plans.schema import CUSTOMERS


def month_label(month: Column) -> Column:
    """``January   2025``: the name is padded to nine characters."""
    return F.concat(
        F.rpad(F.date_format(month, "MMMM"), 9, " "), F.lit(" "), F.date_format(month, "yyyy")
    )


def customer_overview(customers: DataFrame, complaints: DataFrame) -> DataFrame:
    """Each customer with number, first and last date of its complaints.

    Complaints are reduced to one row per customer before the join, which then reuses their
    partitioning and moves the customers only.
    """
    per_customer = complaints.groupBy("customerId").agg(
        F.count("customerId").alias("totalComplaints"),
        F.min("logDate").alias("firstComplaintDate"),
        F.max("logDate").alias("lastComplaintDate"),
    )
    return customers.join(per_customer, "customerId", "left").select(
        *CUSTOMERS.column_names,
        F.coalesce("totalComplaints", F.lit(0)).cast("long").alias("totalComplaints"),
        "firstComplaintDate",
        "lastComplaintDate",
    )


def turnaround_category(days: Column, first: int = 24, second: int = 72) -> Column:
    return (
        F.when(days <= first, "Within 1 day")
        .when(days <= second, "Within 3 days")
        .otherwise("Over 3 days")
    )


def complaint_summary(customers: DataFrame, complaints: DataFrame,
                      first: int = 24, second: int = 72) -> DataFrame:
    """Complaints with the customer's name and number and a turnaround category."""
    who = customers.select("customerId", "name", "number")
    return lookup_join(complaints.drop("number"), who, "customerId", "inner").select(
        "customerId", "name", "number", "profileId", "logDate", "complaintSource",
        "natureOfComplaint", "subject", "detailsOfComplaint", "status", "resolutionDate",
        "turnaroundTime", "location", "region", "updates", "comment",
        "reasonForReversalRequest",
        turnaround_category(F.col("turnaroundTime"), first, second).alias("turnaroundCategory"),
    )


#: Additive measures of the counts that reports are derived from.
REGION_MEASURES = ("n", "days", "timed", "resolved")
TREND_MEASURES = ("n", "days", "timed")


def region_counts(complaints: DataFrame) -> DataFrame:
    """Measures of every known region and customer."""
    return complaints.filter(F.col("region").isNotNull() & (F.col("region") != "Unknown")).groupBy(
        "region", "customerId").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("turnaroundTime"), F.lit(0)).alias("days"),
        F.count("turnaroundTime").alias("timed"),
        F.count_if(F.col("status") == "Resolved").alias("resolved"))


def _average(days: Column, timed: Column) -> Column:
    return F.sum(days).cast("double") / F.nullif(F.sum(timed), F.lit(0))


def regional_stats_of(counts: DataFrame) -> DataFrame:
    """Regional statistics from ``region_counts``."""
    return counts.groupBy("region").agg(
        F.sum("n").alias("totalComplaints"),
        F.count_if(F.col("customerId").isNotNull()).alias("uniqueCustomers"),
        _average(F.col("days"), F.col("timed")).alias("avgTurnaroundTime"),
        F.sum("resolved").alias("resolvedCount"),
    ).withColumn(
        "resolutionRate", rounded_percentage(F.col("resolvedCount"), F.col("totalComplaints")),
    ).orderBy(F.desc("totalComplaints"), "region")


def regional_stats(complaints: DataFrame) -> DataFrame:
    """Volume, customers, turnaround and resolution rate per known region."""
    resolved = F.count_if(F.col("status") == "Resolved")
    total = F.count(F.lit(1))
    return (
        complaints.filter(F.col("region").isNotNull() & (F.col("region") != "Unknown"))
        .groupBy("region")
        .agg(
            total.alias("totalComplaints"),
            F.count_distinct("customerId").alias("uniqueCustomers"),
            F.avg("turnaroundTime").alias("avgTurnaroundTime"),
            resolved.alias("resolvedCount"),
        )
        .withColumn(
            "resolutionRate",
            rounded_percentage(F.col("resolvedCount"), F.col("totalComplaints")),
        )
        .orderBy(F.desc("totalComplaints"), "region")
    )


def status_share(complaints: DataFrame) -> DataFrame:
    """Volume, share of all complaints, turnaround and date range per status.

    The total is a scalar subquery; on a stored table it is answered from file footers.
    """
    per_status = complaints.groupBy("status").agg(
        F.count(F.lit(1)).alias("complaintCount"),
        F.avg("turnaroundTime").alias("avgTurnaroundTime"),
        F.min("logDate").alias("oldestComplaint"),
        F.max("logDate").alias("newestComplaint"),
    )
    total = complaints.agg(F.count(F.lit(1))).scalar()
    return per_status.select(
        "status",
        "complaintCount",
        rounded_percentage(F.col("complaintCount"), total).alias("percentage"),
        "avgTurnaroundTime",
        "oldestComplaint",
        "newestComplaint",
    ).orderBy(F.desc("complaintCount"), "status")


_MONTH = "monthStart"
_TREND_PARTS = ("customerId", "natureOfComplaint", "region")
# Bits of the grouping id, highest first: month, then the three parts; 0 = grouped by it.
_OF_CUSTOMER, _OF_NATURE, _OF_REGION = 0b0011, 0b0101, 0b0110


def trend_counts(complaints: DataFrame) -> DataFrame:
    """Measures of every (month, customer), (month, nature) and (month, region), by one scan."""
    dated = complaints.filter(F.col("logDate").isNotNull()).select(
        F.trunc("logDate", "month").alias(_MONTH), *_TREND_PARTS, "turnaroundTime",
    )
    return dated.groupingSets(
        [(F.col(_MONTH), F.col(p)) for p in _TREND_PARTS], _MONTH, *_TREND_PARTS
    ).agg(
        F.grouping_id(_MONTH, *_TREND_PARTS).alias("by"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("turnaroundTime"), F.lit(0)).alias("days"),
        F.count("turnaroundTime").alias("timed"),
    )


def monthly_trends_of(counts: DataFrame) -> DataFrame:
    """Monthly trends from ``trend_counts``."""
    by_customer = F.col("by") == _OF_CUSTOMER

    def most_frequent(part: str, grouping: int) -> Column:
        counted = (F.col("by") == grouping) & F.col(part).isNotNull()
        ranked = F.when(counted, F.struct((-F.col("n")).alias("n"), F.col(part).alias("value")))
        return F.min(ranked).getField("value")

    return (
        counts.groupBy(_MONTH)
        .agg(
            F.sum(F.when(by_customer, F.col("n"))).alias("totalComplaints"),
            F.count_if(by_customer & F.col("customerId").isNotNull()).alias("uniqueCustomers"),
            _average(F.when(by_customer, F.col("days")), F.when(by_customer, F.col("timed")))
            .alias("avgTurnaroundTime"),
            most_frequent("natureOfComplaint", _OF_NATURE).alias("topComplaintType"),
            most_frequent("region", _OF_REGION).alias("topRegion"),
        )
        .select(
            month_label(F.col(_MONTH)).alias("month"),
            _MONTH, "totalComplaints", "uniqueCustomers", "avgTurnaroundTime",
            "topComplaintType", "topRegion",
        )
        .orderBy(F.desc(_MONTH))
    )


def monthly_summary_of(counts: DataFrame) -> DataFrame:
    """The stored part of the monthly trends from ``trend_counts``."""
    return monthly_trends_of(counts).drop("topComplaintType", "topRegion")


def monthly_trends(complaints: DataFrame) -> DataFrame:
    """Volume, customers, turnaround and most frequent nature and region per month.

    One scan counts per (month, customer), (month, nature) and (month, region); the second,
    small aggregation picks the totals and the most frequent values from those counts. Of
    equally frequent values the smallest is reported.
    """
    return monthly_trends_of(trend_counts(complaints))


def monthly_summary(complaints: DataFrame) -> DataFrame:
    """The part of the monthly trends that is stored."""
    return (
        complaints.filter(F.col("logDate").isNotNull())
        .groupBy(F.trunc("logDate", "month").alias("monthStart"))
        .agg(
            F.count(F.lit(1)).alias("totalComplaints"),
            F.count_distinct("customerId").alias("uniqueCustomers"),
            F.avg("turnaroundTime").alias("avgTurnaroundTime"),
        )
        .select(
            month_label(F.col("monthStart")).alias("month"),
            "monthStart", "totalComplaints", "uniqueCustomers", "avgTurnaroundTime",
        )
        .orderBy(F.desc("monthStart"))
    )


def register_views(spark: SparkSession, customers: DataFrame, complaints: DataFrame,
                   stored_summary: DataFrame | None = None) -> list[str]:
    """Register every report as a temporary view, computed when it is read."""
    views = {
        "vw_customer_overview": customer_overview(customers, complaints),
        "vw_complaint_summary": complaint_summary(customers, complaints),
        "vw_regional_stats": regional_stats(complaints),
        "vw_complaint_status": status_share(complaints),
        "vw_monthly_trends": monthly_trends(complaints),
    }
    if stored_summary is not None:
        views["mv_monthly_complaint_summary"] = stored_summary
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
