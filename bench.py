"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed twice to a sink that reads
every row and keeps none; the shorter time counts. `value` is the sum.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks.catalog import QUERIES, prepared

HEADLINE = (
    "envelope_parse",
    "dedup_events",
    "silver_clean",
    "silver_quarantine",
    "gold_daily_user_metrics",
    "gold_invariants",
    "dq_report",
    "kpi_event_revenue_daily",
    "kpi_order_revenue_daily",
    "kpi_retention",
    "kpi_churn_proxy",
    "kpi_rfm_segments",
    "kpi_daily_summary",
    "customer_360",
    "silver_rebuild",
    "gold_rebuild",
    "publish_replace",
    "bronze_ingest",
    "stream_equals_batch",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("daymark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query, runs = prepared(QUERIES[name]), []
        for _ in range(3):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs[1:]), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
