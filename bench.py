"""Time the headline queries: a warm-up run of each, then the median of the runs.

Every result row is produced and dropped (noop sink); nothing is collected. Prints one
line of JSON. Settings come from BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from pulsetide.plans.queries import QUERIES

HEADLINE = [
    "gold_hourly",
    "bronze_parse",
    "silver_clean",
    "user_metric_summary",
    "long_layout_summary",
    "metric_trend",
    "answer_requests",
    "dq_checks",
    "gold_batch_roundtrip",
    "gold_hourly_stream",
    # Over layers that the query writes first, so pruning and pushed filters count too.
    "recent_windows_layer",
    "user_summary",
]


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds from building the query to its last row."""
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    """Run the bench."""
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # The sample is small: keep its shuffles as wide as the machine.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # All warm-ups come first, so that no query pays for compiling what they share.
    for name in names:
        timed(spark, name, sf_dir)
    seconds = {
        name: round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        for name in names
    }
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
