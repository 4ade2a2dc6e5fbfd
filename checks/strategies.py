"""Times the two ways to find missing rows, and a whole run, on stored tables.

    python -m checks.strategies [folder of generated tables] [copies]

``copies`` repeats the tables with shifted keys, to see how the times grow.
"""

from __future__ import annotations

import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import keysweep as ks
from bench import session
from checks import fixtures as fx
from keysweep.storage import stage, work_folder

SHIFT = 10_000_000


def repeated(df: DataFrame, copies: int) -> DataFrame:
    """``df`` with its transactions repeated under new ids."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return (
        df.withColumn("copy", copy)
        .withColumn("transaction_id", F.col("transaction_id") + F.col("copy") * SHIFT)
        .drop("copy")
    )


def median(action: Callable[[], object], runs: int = 3) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 2)


def evaluate(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def measure(spark: SparkSession, sf_dir: str, copies: int) -> None:
    folder, keys = work_folder(spark, "strategies"), fx.PAIR.keys
    target = repeated(fx.tgt_pair(spark, sf_dir), copies)
    source = stage(repeated(fx.src_pair(spark, sf_dir), copies), f"{folder}/source")
    paths = [f"{folder}/table{i}" for i in range(2)]
    for path in paths:
        ks.write_partitioned(target, path)

    def active() -> DataFrame:
        return ks.read_target_active(spark, paths[0])

    print("target rows", ks.read_target(spark, paths[0]).count(), "source rows", source.count())
    wide = median(lambda: evaluate(ks.missing_in_source(active(), source, keys)))

    def by_key(even: bool) -> float:
        def run() -> None:
            place = work_folder(spark, "by_key")
            evaluate(ks.find_missing(active(), source, keys, place, even=even))

        return median(run)

    aggregated, joined = by_key(False), by_key(True)
    start = time.perf_counter()
    flagged = ks.reconcile(spark, fx.PAIR, source, paths[1]).flagged_count
    print("wide-row anti join", wide, "key-first, aggregated", aggregated, "joined", joined)
    print("whole run", round(time.perf_counter() - start, 2), "flagged", flagged)


if __name__ == "__main__":
    arguments = sys.argv[1:]
    spark = session("8")
    measure(
        spark,
        arguments[0] if arguments else "/root/testdata/sf0.1",
        int(arguments[1]) if len(arguments) > 1 else 1,
    )
    spark.stop()
