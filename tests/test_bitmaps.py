"""Integer keys compared as bitmaps, and the measures that choose the comparison."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keysweep.operators import bitmaps
from keysweep.operators.missing import AGGREGATE, BITMAP, JOIN, Measured, find_missing, measured, missing_in_source, missing_keys, stage_keys, way_of
from keysweep.storage import work_folder

LONGS = st.integers(-(2**63), 2**63 - 1)
KEYS = st.lists(st.one_of(st.none(), st.integers(-200, 200), LONGS, st.sampled_from([-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65])), max_size=40)


def keys_of(df):
    return sorted(row[0] for row in df.collect())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=KEYS, source=KEYS)
def test_equals_the_anti_join(spark, target, source):
    ours = spark.createDataFrame([(k,) for k in target], "id bigint")
    theirs = spark.createDataFrame([(k,) for k in source], "id bigint")
    want = sorted({k for k in target if k is not None} - set(source))
    assert keys_of(bitmaps.missing_integers(ours, theirs, "id")) == want
    assert keys_of(missing_keys(ours, theirs, ["id"], way=BITMAP)) == want


@pytest.mark.parametrize(("kind", "low", "high"), [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -(2**31), 2**31 - 1)])
def test_types_and_their_limits(spark, kind, low, high):
    ours = spark.createDataFrame([(low,), (high,), (0,), (0,), (None,)], f"`a key` {kind}")
    theirs = spark.createDataFrame([(0,), (None,)], f"`a key` {kind}")
    found = bitmaps.missing_integers(ours, theirs, "a key")
    assert found.dtypes == [("a key", kind)]
    assert keys_of(found) == [low, high]


def test_dense_keys_shuffle_a_row_for_each_word(spark):
    ours, theirs = spark.range(0, 64_000, 1, 4), spark.range(0, 64_000, 1, 4).filter("id % 7 <> 3")
    found = bitmaps.missing_integers(ours, theirs, "id")
    assert found.count() == 64_000 - theirs.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1 and "Join" not in plan and "Python" not in plan
    # What reaches the shuffle is counted in the finished plan.
    staged = bitmaps.key_density(ours, "id")
    assert staged.rows == 64_000 and 900 <= staged.words <= 1100 and staged.dense


def test_ways(spark):
    dense, even, hot = Measured(9, 9, True, False), Measured(9, 9, False, True), Measured(9, 9, False, False)
    assert way_of(dense, dense) == BITMAP
    assert way_of(even, even) == JOIN
    assert {way_of(*pair) for pair in ((dense, even), (even, dense), (hot, even), (hot, dense), (even, hot))} == {AGGREGATE}
    assert measured(spark.range(0, 5000, 1, 3), ["id"]).dense
    scattered = spark.range(5000).selectExpr("xxhash64(id) as id")
    assert measured(scattered, ["id"]) == Measured(5000, measured(scattered, ["id"]).broadcast_bytes, False, True)
    assert not measured(spark.range(5000), ["id"], null_safe=True).dense
    assert not measured(spark.range(5000).selectExpr("cast(id as string) as id"), ["id"]).dense
    assert measured(spark.range(0), ["id"]) == Measured(0, 0, False, True)


@pytest.mark.parametrize("kind", ["dense", "scattered", "copies"])
def test_find_missing_chooses(spark, kind):
    rng = random.Random(kind)
    numbers = {"dense": range(3000), "scattered": [rng.getrandbits(60) for _ in range(3000)], "copies": [5] * 2000 + list(range(1000))}[kind]
    target = spark.createDataFrame([(n, str(i)) for i, n in enumerate(numbers)] + [(None, "null")], "id bigint, v string")
    source = spark.createDataFrame([(n,) for n in numbers if n % 3] + [(None,)], "id bigint")
    found = find_missing(target, source, ["id"], work_folder(spark), broadcast_limit=-1)
    want = missing_in_source(target, source, ["id"])
    assert found.exceptAll(want).count() == want.exceptAll(found).count() == 0
    assert found.count() > 1


def test_the_write_counts_the_keys(spark):
    source = spark.range(0, 10_000, 1, 7).select("id", F.lit("more").alias("v"))
    rows, seen = stage_keys(source, ["id"], f"{work_folder(spark)}/keys")
    assert rows.columns == ["id"] and seen.rows == rows.count() == 10_000
    assert seen.broadcast_bytes == measured(rows, ["id"]).broadcast_bytes
    empty, none = stage_keys(source.limit(0), ["id"], f"{work_folder(spark)}/keys")
    assert (none.rows, none.broadcast_bytes, empty.count()) == (0, 0, 0)


def test_counts_survive_repeated_tasks(spark):
    """Tasks that fail and are repeated, after they have read some of their rows, count once."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys, tempfile
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark import TaskContext
spark = SparkSession.builder.master("local[2, 3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from keysweep.operators.missing import stage_keys
def failing(batches):
    for k, batch in enumerate(batches):
        yield batch
        if k == 1 and TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
rows = spark.range(0, 5000, 1, 4).repartition(3, "id").mapInArrow(failing, "id long")
staged, seen = stage_keys(rows, ["id"], tempfile.mkdtemp() + "/keys")
print(seen.rows, staged.count(), staged.distinct().count())
spark.stop()
"""
    found = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=True)
    assert found.stdout.split() == ["5000"] * 3
