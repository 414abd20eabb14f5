"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tastecore.queries import QUERIES

HEADLINE = [
    "mismatch_anti_join",
    "active_triplets",
    "song_popularity",
    "user_activity",
    "most_active_user",
    "exact_quantiles",
    "summary_quartiles",
    "describe_columns",
    "correlation_matrix",
    "top_plays",
    "genre_distribution",
    "genre_join",
    "per_user_holdout",
    "balanced_downsample",
    "index_users_items",
    "standard_scale",
    "ground_truth_lists",
    "ndcg_at_k",
    "roc_auc",
    "multiclass_metrics",
    "kde_by_class",
    "density_curve",
    "scatter_matrix_bins",
    "attribute_csv_scan",
    "directory_usage",
    "logistic_binary",
    "random_forest",
    "recommendation_experiment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tastecore-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
