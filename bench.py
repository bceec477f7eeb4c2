"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local threads. Each query is
run once to warm up and then ``BENCH_RUNS`` times; the fastest run counts. Results go to the no-op sink,
which computes every row and column of them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "e1_user_daily_engagement",
    "e2_user_daily_revenue",
    "e3_product_performance",
    "e4_segment_performance",
    "e5_segment_rollup",
    "q4_suite",
    "g1_run_spec",
    "b1_top_users",
    "b7_category_performance",
    "b11_segment_by_category",
    "b13_lifetime_value",
    "b14_product_mix",
    "j4_split_outer",
    "j10_star",
    "n1_row_number",
    "n2_latest",
    "a18_exact_percentile",
    "a19_collect_values",
    "w5_merge_rows",
    "r4_stateful_daily_metrics",
    "r14_stream_stream_join",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python line behind every column takes longer than planning these queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalogue import QUERIES

    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
