"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default: all)
BENCH_QUERIES  comma-separated keys, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from connlens.plans import QUERIES

HEADLINE = [
    "sql_topk_groups",
    "parse_interactions",
    "parse_reject",
    "filter_like",
    "group_count",
    "group_by_predicate",
    "sum_count_by_tag",
    "mean_by_tag",
    "class_totals",
    "except_distinct",
    "except_all",
    "intersect_rows",
    "cross_observed",
    "sample_ratio",
    "sample_exact",
    "pagerank",
    "column_stats_by_tag",
    "variable_stats",
    "spearman_matrix",
    "pearson_matrix",
    "chi_square",
    "encode_categories",
    "classification_metrics",
    "logistic_chi",
    "decision_tree",
    "random_forest",
    "gradient_boosting",
    "linear_svm",
    "model_comparison",
    "stream_lines",
    "stream_sql",
]


def session(cpus: str) -> SparkSession:
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("connlens-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    chosen = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "*"))
    # Start-up and the first reading of the largest table are not part of any query.
    QUERIES["group_count"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for key in keys:
        start = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
