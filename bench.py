"""Time the headline queries: one warm-up, then the median of three runs, in seconds.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (comma-separated,
or ``all``) a selection. Results go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.workload import bank  # noqa: E402
from ledgerspark.workload.queries import queries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "dedup_latest",
    "clean_transactions",
    "currency_to_usd",
    "profile_exact",
    "stream_ingest",
    "stream_silver",
    "agg_channel",
    "agg_customer",
    "agg_location",
    "agg_date",
    "customer_type_agg",
    "churn_status",
    "amount_histogram",
    "median_exact",
    "percent_of_total",
    "txn_with_location",
    "join_three",
    "customer_segmentation",
    "fraud_velocity",
    "fraud_flags",
    "last_txn_window",
    "cumulative_sum",
    "rolling_avg_rows",
    "rolling_avg_days",
    "sequential_ids",
    "audit_integrity",
    "publish_gold",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def measure(action) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(RUNS)), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    registered = queries()
    names = chosen.split(",") if chosen else HEADLINE
    if chosen == "all":
        names = list(registered)
    seconds = {"build_silver": measure(lambda: bank.build_silver(spark, SF_DIR))}
    for name in names:
        run = registered[name]
        seconds[name] = measure(
            lambda: run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total time of headline queries, median of runs after a warm-up",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
