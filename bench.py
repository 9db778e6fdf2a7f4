"""Time the headline queries; prints one JSON line.

Silver and gold are stored once, as a run stores them; the reports are timed on the stored gold tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from caseloom.plans import reports
from caseloom.session import build_session
from workloads.catalogue import QUERIES, new_store, stage, stored_silver

BEFORE = ("sheet_fingerprint", "phone_e164", "title_case_text", "fuzzy_region")
AFTER = ("status_share_of_orders", "monthly_trends_of_orders", "overview_of_order_customers")


def read_whole(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the session's file, shuffle and code generation paths outside the timings.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}

    def timed(name: str, step):
        start = time.perf_counter()
        out = step()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    for name in BEFORE:
        timed(name, lambda: read_whole(QUERIES[name](spark, sf_dir)))
    store = new_store(spark, "bench")
    silver = timed("silver_table", lambda: stored_silver(spark, sf_dir, store))
    customers, complaints = timed("complaints_of_customers",
                                  lambda: stage(spark, silver, sf_dir, store))
    timed("customer_overview", lambda: read_whole(reports.customer_overview(customers, complaints)))
    timed("regional_stats", lambda: read_whole(reports.regional_stats(complaints)))
    timed("monthly_trends", lambda: read_whole(reports.monthly_trends(complaints)))
    for name in AFTER:
        timed(name, lambda: read_whole(QUERIES[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "total wall time of headline queries, reports on stored gold",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
