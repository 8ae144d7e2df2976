"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_QUERIES (optional) the
queries to time, separated by commas, BENCH_RUNS how often each is run (default 3; the median counts).
Every result is written to the noop sink, so all columns are
computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import CHECKS  # noqa: E402
from narrata.session import local_session  # noqa: E402

HEADLINE = [
    "null_counts", "duplicate_rows", "low_cardinality", "dedup_first", "clean_narratives",
    "clean_text", "derived_features", "filter_funnel", "category_distribution", "length_stats",
    "length_histogram", "length_boxplot", "stratified_sample", "sampling_stats", "simple_sample",
    "chunk_window", "chunk_recursive", "chunk_recursive_stats", "hash_embed", "store_add",
    "topk_l2", "batch_topk", "batch_topk_own_filter", "context", "answers", "evaluation_table",
    "index_build_counts", "ingest_counts", "incremental_append", "answer_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "8g"), app="narrata-bench")
    spark.sparkContext.setLogLevel("ERROR")
    CHECKS["category_distribution"][0](spark, sf_dir).collect()  # start the JVM side and the workers
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            CHECKS[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
