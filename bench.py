"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tracelake.catalog import QUERIES, runner
from tracelake.session import start

HEADLINE = [
    "daily_trace_count", "daily_tokens_cost", "monthly_rollup", "snapshot_table", "cumulative_traces", "duration_series",
    "ttl_matches", "ttl_counts", "ttl_kept", "delete_audit",
    "composite_scores", "score_series_daily", "slice_metrics", "governance_cube",
    "evaluate_metrics", "experiment_stats", "leaderboard", "pass_rate",
    "round_robin", "enrich_context", "thread_parts",
    "span_tree", "stitch", "attr_mapping", "assemble_traces",
    "rule_scores_batch", "rule_scores_stream", "thread_sessions",
    "topk_cosine", "chunk_words", "number_chunks", "secret_scan", "entry_errors",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = start(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run = runner(QUERIES[name])
        times = []
        for _ in range(runs):
            began = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
