"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. Every query is run
once to warm up and then timed, writing its whole result to a sink.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from feedmill.queries import all_queries

HEADLINE = [
    "flagship_silver_summary",
    "flagship_silver_rows",
    "job_01_load_queued_files",
    "job_02_silver_batch",
    "src_05_csv_scan",
    "src_06_excel_scan",
    "rule_02_quality_metrics",
    "rule_09_keep_first",
    "rule_11_quarantine_all",
    "rule_18_aggregate_column",
    "dq_10_thresholds",
    "map_08_combined_score",
    "merge_03_silver_upsert",
    "view_09_file_mapping_coverage",
    "rep_07_provider_file_status",
    "rep_21_schema_discovery",
    "agg_03_distinct_counts",
    "join_14_repeated_keys",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = all_queries()
    seconds = {}
    for name in HEADLINE:
        run = registered[name].run
        for _ in range(2):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "silver_batch_records_per_min": round(orders / seconds["job_02_silver_batch"] * 60),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
