"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table directory, BENCH_CPUS the local cores. Every query
runs once to warm up and once timed, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import querybook  # noqa: E402

HEADLINE = (
    "label_store", "dpd_daily", "silver_loan_daily", "quarantine_split", "point_in_time_join", "point_in_time_latest",
    "trailing_window_features", "feature_store", "feature_store_latest", "training_set", "lag_alignment",
    "auc_by_month", "model_metrics", "exact_percentiles", "overall_action", "roundtrip_parquet", "fit_logistic", "score_batch", "psi",
    "preprocess_stats", "data_build",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),  # one process: its own folder is shared
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            querybook.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
