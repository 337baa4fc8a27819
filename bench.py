"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query is planned and run in full into Spark's
no-op sink, so nothing is skipped and nothing passes through the driver. Each
runs once to warm up the JVM and then ``$BENCH_RUNS`` times (default 2); the
best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from lakestrata.settings import apply_scale_settings
from lakestrata.workload.registry import load_all

HEADLINE = [
    "sales_by_masked_state",
    "consolidate_customer_first",
    "consolidate_order_first",
    "consolidate_preaggregated",
    "mask_policy",
    "mask_pseudonym",
    "suite_results",
    "suite_examples",
    "quarantine_rejected",
    "build_dim_cliente",
    "build_fato_vendas",
    "star_load_counts",
    "batch_pipeline",
    "gold_sales_rollup",
    "insert_if_absent",
    "upsert",
    "dedupe_first",
    "sequence_ids",
    "audit_rows_preset",
    "audit_summary",
    "audit_top_violations",
    "regional_weather",
    "flatten_weather",
    "parse_monitor_log",
    "sales_transform",
    "sales_stream",
    "activity_windows",
    "encrypt_roundtrip",
    "dp_noise_keyed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakestrata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture for error messages costs as much as planning itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # One file per table: cut it finely enough for all cores.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_scale_settings(spark)
    queries = load_all()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            if attempt:
                best = taken if best is None else min(best, taken)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total of best warm runs", "value": total, "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
