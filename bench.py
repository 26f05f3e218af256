"""Run the headline queries once each, after a warm-up, and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables and ``BENCH_CPUS`` the number of threads. Every
query is computed in full, all rows and columns, into a sink that keeps nothing.
``BENCH_ALL=1`` runs every registered query.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tallyfit.catalog import QUERIES

HEADLINE = [
    "csv_scan_infer", "csv_scan_strings", "csv_sink_predictions", "project_exprs",
    "missing_profile", "drop_missing_columns", "class_balance", "attach_features",
    "hash_split", "clean_text", "udf_clean_text", "tokenize", "remove_stopwords",
    "hashing_tf", "term_frequency", "document_frequency", "tf_idf", "index_categories",
    "index_categories_table", "one_hot", "assemble_features", "vector_index",
    "covariance_matrix", "pca_project", "per_label_metrics", "weighted_metrics",
    "binary_auc", "linreg_simple", "logreg_predict", "random_forest_predict", "pca_logreg",
    "tune_train_validation", "tune_cross_validation", "attach_by_position", "random_split",
    "term_selection", "forest_walk", "house_price_predictions", "pca_spectrum", "logreg_groups", "logreg_objective",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyfit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, where: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    for name in ("clean_text", "class_balance", "linreg_simple"):
        run(name, folder)
    seconds = {}
    for name in names:
        seconds[name] = run(name, folder)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(folder.rsplit("sf", 1)[-1]) if "sf" in folder else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
