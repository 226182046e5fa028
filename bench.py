"""Headline query times, printed as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS
(default 8) the local cores. Every query runs twice into the noop sink and the
second run counts; BENCH_QUERIES may name a subset.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tapeloom.plans.staging import drop_staged
from workload.queries import QUERIES

HEADLINE = [
    "daily_bars",
    "weekly_bars",
    "segment_bars",
    "universe_filter",
    "log_returns",
    "rolling_volatility",
    "moving_averages",
    "rsi",
    "rolling_corr",
    "silver_features",
    "silver_features_parts",
    "hourly_features",
    "tick_features",
    "dim_date",
    "latest_price",
    "scd2_initial",
    "scd2_apply",
    "inferred_members",
    "fact_bars",
    "referential_integrity",
    "quality_profile",
    "zscore_features",
    "next_day_target",
    "class_weights",
    "classification_metrics",
    "kmeans_regimes",
    "rf_predictions",
    "group_sum",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # windows over few bytes are still heavy on CPU: keep all local cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
            drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
