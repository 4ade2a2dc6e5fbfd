"""Digests of key ranges kept between runs: the same update sets, and unchanged ranges are not compared."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import keysweep as ks
from keysweep.operators import digests as dg
from keysweep.storage import stage, work_folder

KEYS = {
    "numbers": (("id",), "id long", lambda n: (n * 1000,)),
    "texts": (("a", "b"), "a string, b int", lambda n: (f"k{n % 97}", n)),
}


def table_of(spark, rows, schema, path):
    ks.write_partitioned(spark.createDataFrame(rows, f"{schema}, at long, is_deleted string, partition_key string"), path)


def flagged(spark, path):
    return sorted(map(tuple, ks.read_target(spark, path).filter("is_deleted = '1'").drop("at").collect()), key=repr)


@pytest.mark.parametrize("kind", KEYS)
def test_runs_flag_what_a_full_comparison_flags(spark, kind):
    keys, schema, key = KEYS[kind]
    rng = random.Random(kind)
    folder = work_folder(spark, "digests")
    spec = ks.TableSpec("t", keys, "at")
    live = set(range(400))
    null = tuple(None for _ in keys)
    rows = [(*key(n), 0, "0", "p" if n % 2 else "q") for n in sorted(live)] + [(*null, 0, "0", "p")]
    for name in ("by_digest", "whole"):
        table_of(spark, rows, schema, f"{folder}/{name}")
    for turn in range(4):
        if turn == 1:
            # A row that the source never had at the time of a run, in a range that is the same in the source.
            ghost = [(*key(5000), 1, "0", "p"), (*null, 1, "0", "q")]
            for name in ("by_digest", "whole"):
                spark.createDataFrame(ghost, f"{schema}, at long, is_deleted string, partition_key string").write.mode("append").partitionBy(
                    "partition_key"
                ).parquet(f"{folder}/{name}")
        if turn == 2:
            live -= set(rng.sample(sorted(live), 3))
        source = spark.createDataFrame([key(n) for n in sorted(live)], schema)
        found = ks.reconcile(spark, spec, source, f"{folder}/by_digest", digests=f"{folder}/kept").flagged_count
        assert found == ks.reconcile(spark, spec, source, f"{folder}/whole").flagged_count
        assert flagged(spark, f"{folder}/by_digest") == flagged(spark, f"{folder}/whole")
        assert found == [1, 2, 3, 0][turn]
    assert dg.read_digests(spark, f"{folder}/kept").generation == 3


def numbers(spark, condition="true"):
    return spark.range(0, 200_000, 1, 4).filter(condition)


def test_only_changed_ranges_are_compared(spark):
    folder = work_folder(spark, "digests")
    keys, before = ["id"], numbers(spark)
    shift = dg.width_of(before.selectExpr("id * 50 as id"), keys)
    first = stage(dg.both_sides(*[dg.key_digests(before, keys, shift)] * 2), f"{folder}/first")
    after = numbers(spark, "id not in (7, 150000)")
    now = dg.both_sides(dg.key_digests(after, keys, shift), dg.key_digests(before, keys, shift))
    changed = stage(dg.changed_ranges(now, first), f"{folder}/changed")
    assert {r.range for r in changed.collect()} == {7 >> shift, 150_000 >> shift}
    ours, theirs = (dg.in_ranges(df, changed, keys, shift) for df in (before, after))
    assert ours.count() == 2 << shift and theirs.count() == ours.count() - 2
    found = ks.missing_keys(ours, theirs, keys)
    assert sorted(r.id for r in found.collect()) == [7, 150_000]
    # Rows are filtered by the broadcast ranges below the shuffle, and by nothing above it.
    plan = ks.missing_keys(ours, theirs, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(id") < plan.index("BroadcastHashJoin")
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    ("before", "after"), [("id <> 5", "id <> 6"), ("true", "id < 100000"), ("id < 1000", "true"), ("id < 10", "id < 10 or id = 199999")]
)
def test_changes_are_found(spark, before, after):
    keys, shift = ["id"], 4
    one, two = (dg.key_digests(numbers(spark, c), keys, shift) for c in (before, after))
    changed = dg.changed_ranges(dg.both_sides(one, two), dg.both_sides(one, one))
    want = numbers(spark, f"({before}) <> ({after})").select(F.shiftright("id", shift)).distinct()
    assert sorted(r[0] for r in changed.collect()) == sorted(r[0] for r in want.collect())
    assert dg.changed_ranges(dg.both_sides(one, two), dg.both_sides(one, two)).count() == 0


def test_digests_without_flagged_rows_are_those_of_the_rest(spark):
    keys, shift = ["id"], 8
    gone, rest = numbers(spark, "id % 3 = 0 or id < 5000"), numbers(spark, "not (id % 3 = 0 or id < 5000)")
    left = dg.without(dg.key_digests(numbers(spark), keys, shift), dg.key_digests(gone, keys, shift))
    want = dg.key_digests(rest, keys, shift)
    assert left.exceptAll(want).count() == want.exceptAll(left).count() == 0


def test_unfinished_digests_are_not_read(spark):
    folder = f"{work_folder(spark, 'digests')}/kept"
    assert dg.read_digests(spark, folder) is None
    rows = stage(dg.both_sides(*[dg.key_digests(numbers(spark), ["id"], 6)] * 2), f"{folder}-rows")
    dg.write_digests(rows, folder, 6, None)
    kept = dg.read_digests(spark, folder)
    assert (kept.shift, kept.generation, kept.rows.count()) == (6, 0, rows.count())
    # Half of the next generation: the last whole one counts.
    rows.limit(5).selectExpr("1L as generation", "6 as shift", "100L as total", "*").write.parquet(f"{folder}/{1:019d}-half")
    assert dg.read_digests(spark, folder).generation == 0
    dg.write_digests(rows, folder, None, kept)
    assert dg.read_digests(spark, folder).shift is None


def test_ranges_of_keys(spark):
    assert dg.width_of(spark.range(0), ["id"]) == 0
    assert dg.width_of(spark.range(dg.RANGES - 1), ["id"]) == 0
    ends = spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "id long")
    shift = dg.width_of(ends, ["id"])
    assert ends.select(dg.range_of(["id"], shift)).distinct().count() == 2
    assert (2**64 >> shift) <= dg.RANGES
    assert dg.width_of(spark.createDataFrame([("x",)], "id string"), ["id"]) is None
