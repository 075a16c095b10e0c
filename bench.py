"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  data directory (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up (default 3, the median counts)
    BENCH_QUERIES comma-separated names instead of the headline set
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_full", "filter_where", "filter_expr", "page_2", "json_get_int", "json_array_has",
    "knn_l2", "knn_columns", "knn_filter_where", "knn_join", "knn_join_cosine",
    "ivf_flat_all_probes", "pq_refine_full",
    "merge_upsert", "merge_shuffled", "merge_condition", "delete_sql", "stored_merge",
    "take_ids", "id_manifest", "batches_shuffled", "batch_transform", "sample_without", "sample_with",
    "with_embeddings", "create_scan", "append_union", "import_json_rows", "import_jsonl", "import_arrow",
    "fts_postings", "range_layout_lookup",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from karst.workload import QUERIES
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("karst-bench")
             .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            # a full result in Spark's own format, without moving rows to the driver
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
