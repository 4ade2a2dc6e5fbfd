"""Partitions replaced by switching their locations: no step loses a row, and a repeated run converges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import keysweep as ks
from keysweep.sinks import swap
from keysweep.sinks.files import child_folders
from keysweep.storage import work_folder

DATABASE = "switched"
VALUES = ["a", "b", "c/d=e '\\", None]
SPEC = ks.TableSpec("t", ("id",), "at")


class Crash(Exception):
    pass


@pytest.fixture
def table(spark):
    """A catalog table of 40 rows in four partitions, one of them NULL."""

    def make(name):
        rows = [(i, 1, "0", VALUES[i % 4]) for i in range(40)]
        path = work_folder(spark, "swap") + "/table"
        ks.write_partitioned(spark.createDataFrame(rows, "id long, at long, is_deleted string, partition_key string"), path)
        return ks.publish_table(spark, path, DATABASE, name, database_path=f"{path}_database"), path

    return make


def flags(spark, name):
    rows = ks.read_registered(spark, name).collect()
    assert len(rows) == 40 and {r.id for r in rows} == set(range(40))
    assert all(r.partition_key == VALUES[r.id % 4] for r in rows)
    return {r.id for r in rows if r.is_deleted == "1"}


def flagged(spark, name):
    """The rows of three partitions with every third one flagged."""
    rows = ks.read_registered(spark, name).filter("partition_key is null or partition_key <> 'b'")
    return rows.withColumn("is_deleted", F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("is_deleted")))


GONE = {i for i in range(40) if i % 3 == 0 and i % 4 != 1}


@pytest.mark.parametrize("step", range(9))
def test_a_crash_between_any_two_steps(spark, table, monkeypatch, step):
    name, path = table(f"crash_{step}")
    done = 0

    def counted(do):
        def run(*args):
            nonlocal done
            if done == step:
                raise Crash
            done += 1
            return do(*args)

        return run

    with monkeypatch.context() as patched:
        # One write, a switch for each of three partitions, and a removal of each old folder.
        for step_name in ("write_generation", "switch", "delete_folder"):
            patched.setattr(swap, step_name, counted(getattr(swap, step_name)))
        crashed = False
        try:
            ks.swap_partitions(flagged(spark, name), name)
        except Crash:
            crashed = True
    assert crashed == (step < 7)
    found = flags(spark, name)
    assert found <= GONE and (found == GONE) == (step >= 4)
    ks.swap_partitions(flagged(spark, name), name)
    assert flags(spark, name) == GONE
    ks.remove_unused(spark, name)
    assert flags(spark, name) == GONE
    generations = [folder for g in child_folders(spark, f"{path}/{swap.GENERATIONS}") for folder in child_folders(spark, g)]
    assert len(generations) == 3 and len([f for f in child_folders(spark, path) if "partition_key=" in f]) == 1
    assert ks.remove_unused(spark, name) == 0


def test_runs_and_upserts_by_the_catalog(spark, table):
    name, path = table("t")
    options = ks.Options(swap_locations=True)
    with pytest.raises(ValueError, match="a database must be given"):
        ks.reconcile(spark, SPEC, spark.range(40), path, options=options)
    for missing in (5, 7):
        source = spark.range(40).filter(f"id % {missing} <> 0")
        ks.reconcile(spark, SPEC, source, path, database=DATABASE, options=options)
    assert flags(spark, name) == {i for i in range(40) if i % 5 == 0 or i % 7 == 0}
    assert ks.reconcile(spark, SPEC, source, path, database=DATABASE, options=options).flagged_count == 0
    batch = spark.createDataFrame([(3, 2, "x"), (100, 1, "new"), (101, 1, None)], "id long, at long, partition_key string")
    assert ks.upsert_to_table(spark, batch, name, ["id"], "at") == 3
    after = {r.id: r for r in ks.read_registered(spark, name).collect()}
    assert (after[3].at, after[3].partition_key, after[100].partition_key, after[101].partition_key) == (2, VALUES[3], "new", None)
    assert len(after) == 42 and spark.sql(f"SHOW PARTITIONS {name}").count() == 5
    # Known partitions are not lost when the table is published again.
    assert ks.remove_unused(spark, name) == 0


def test_rows_that_do_not_fit_the_registered_table_are_not_written(spark, table):
    name, path = table("narrow")
    rows = ks.read_target(spark, path)
    spec = ks.TableSpec("narrow", ("id",), "at")
    rows.withColumn("more", F.lit(1)).write.mode("append").partitionBy("partition_key").parquet(path)
    before = ks.read_target(spark, path).filter("is_deleted = '1'").count()
    with pytest.raises(ValueError, match=r"extra: \['more'\]"):
        ks.reconcile(spark, spec, spark.range(10), path, database=DATABASE)
    assert ks.read_target(spark, path).filter("is_deleted = '1'").count() == before == 0
    name, path = table("typed")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} (id long, at int, is_deleted string, partition_key string) USING parquet PARTITIONED BY (partition_key) LOCATION '{path}'")
    with pytest.raises(ValueError, match="at type mismatch"):
        ks.reconcile(spark, ks.TableSpec("typed", ("id",), "at"), spark.range(10), path, database=DATABASE)
