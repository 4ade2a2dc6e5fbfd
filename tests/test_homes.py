"""The index of the partitions that keys are stored in: same upserts, no shuffle of the index, no trust in a stale one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import keysweep as ks
from keysweep.operators import homes
from keysweep.storage import work_folder

DATABASE = "indexed"
SCHEMA = "a long, b string, at long, v string, partition_key string"
KEYS = ["a", "b"]


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(homes.build_index, "__defaults__", (4,))


def made(spark, name, rows):
    path = work_folder(spark, "homes") + "/table"
    ks.write_partitioned(spark.createDataFrame(rows, SCHEMA), path)
    return ks.publish_table(spark, path, DATABASE, name, database_path=f"{path}_database"), homes.index_name(DATABASE, name)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(rng, n, turn):
    keys = {(rng.choice((None, *range(12))), rng.choice((None, "x", "y'", "z"))) for _ in range(n)}
    return [(a, b, turn, f"{turn}", rng.choice(("p", "q/r", None))) for a, b in keys]


def test_upserts_are_those_by_a_scan(spark):
    rng = random.Random(7)
    first = some(rng, 25, 0)
    (one, index), (two, _) = made(spark, "one", first), made(spark, "two", first)
    for turn in (1, 2):
        batch = spark.createDataFrame(some(rng, 15, turn), SCHEMA)
        counts = [ks.upsert_to_table(spark, batch, name, KEYS, "at", index=i) for name, i in ((one, index), (two, None))]
        assert counts[0] == counts[1]
        assert rows_of(ks.read_registered(spark, one)) == rows_of(ks.read_registered(spark, two))
        stored = ks.read_registered(spark, one)
        assert homes.is_current(spark, index, stored)
        places = {(r.key_0, r.key_1): r.home for r in spark.table(index).collect()}
        assert places == {(r.a, r.b): r.partition_key for r in stored.collect()}


def test_the_index_is_not_shuffled(spark):
    name, index = made(spark, "plan", [(i, "x", 0, "0", "p") for i in range(50)])
    stored = ks.read_registered(spark, name)
    homes.build_index(spark, stored, index, KEYS, "partition_key")
    wanted = spark.range(5, 500, 1, 3).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    found = homes.homes_of(spark, wanted, index, KEYS, "partition_key")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
    assert plan.index("Range (5, 500") > plan.index("Exchange")
    assert sorted(r.a for r in found.collect()) == list(range(5, 50))


@pytest.mark.parametrize("change", ["more rows", "another partition", "fewer rows"])
def test_a_stale_index_is_built_anew(spark, change):
    name, index = made(spark, change.replace(" ", "_"), [(i, "x", 0, "0", "pq"[i % 2]) for i in range(20)])
    batch = spark.createDataFrame([(3, "x", 1, "new", "other"), (100, "x", 1, "new", "q"), (200, "x", 1, "new", "q")], SCHEMA)
    homes.build_index(spark, ks.read_registered(spark, name), index, KEYS, "partition_key")
    now = {
        "more rows": [(i, "x", 0, "0", "pq"[i % 2]) for i in range(20)] + [(100, "x", 0, "0", "p")],
        "another partition": [(i, "x", 0, "0", "qp"[i % 2]) for i in range(20)],
        "fewer rows": [(i, "x", 0, "0", "pq"[i % 2]) for i in range(3, 20)],
    }[change]
    ks.swap_partitions(spark.createDataFrame(now, SCHEMA), name)
    ks.upsert_to_table(spark, batch, name, KEYS, "at", index=index)
    want = {(a, b): (at, v, p) for a, b, at, v, p in now}
    for a in (3, 100, 200):
        want[a, "x"] = (1, "new", want[a, "x"][2] if (a, "x") in want else "q")
    assert {(r.a, r.b): (r["at"], r.v, r.partition_key) for r in ks.read_registered(spark, name).collect()} == want
    assert homes.is_current(spark, index, ks.read_registered(spark, name))


def test_keys_that_are_stored_twice_are_refused(spark):
    name, index = made(spark, "twice", [(1, "x", 0, "0", "p"), (1, "x", 0, "0", "q")])
    batch = spark.createDataFrame([(1, "x", 1, "new", "p")], SCHEMA)
    with pytest.raises(Exception, match="not unique"):
        ks.upsert_to_table(spark, batch, name, KEYS, "at", index=index)
