"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR is the folder of generated tables, BENCH_CPUS the number of local threads, BENCH_QUERIES an
optional comma list of query names ("all" for every query). Each query runs once to warm up; the value is
the median of three further runs, each including its writes and the evaluation of its whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "target_active_scan",
    "left_join_flagged",
    "missing_in_source_single",
    "missing_in_source_pair",
    "missing_in_source_five",
    "missing_in_source_five_nullsafe",
    "run_counts",
    "latest_wins_pair",
    "upsert_events",
    "upsert_keeps_partition",
    "upsert_soft_delete",
    "partitioned_publish",
    "soft_delete_end_to_end",
    "reconcile_all_configured",
    "reconcile_evolved_files",
)
# Other ways to the same rows, timed beside the total.
VARIANTS = ("missing_in_source_pair_wide", "missing_in_source_pair_by_key", "missing_in_source_bitmap")
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("keysweep-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="keysweep-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session(cpus)
    times, variants = {}, {}
    for name in (*names, *(() if chosen else VARIANTS)):
        seconds(spark, sf_dir, name)
        own = times if name in names else variants
        own[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "total time of the headline queries, median of 3 runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "variants": variants,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
