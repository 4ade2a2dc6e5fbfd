"""CSV files with line breaks in fields, read by many tasks for each file."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import keysweep as ks
from keysweep.sources import csv_split
from keysweep.sources.target import write_csv_snapshot
from keysweep.storage import work_folder

SCHEMA = "k string, `a, b` string, n int"


@pytest.fixture
def split_at(spark):
    """Files are split every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")

    def at(size):
        for name, value in zip(names, (size, 0, 1)):
            spark.conf.set(name, value)

    yield at
    for name in names:
        spark.conf.unset(name)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", '"', '""', "\n", "\r\n", ",", " ", "é😀", "\\", "\\\"", "line\nbreak", '"\n"', "x" * 40]
    field = lambda: None if rng.random() < 0.1 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
    return [(field(), field(), rng.choice((None, i))) for i in range(n)]


def one_file(spark, rows, schema=SCHEMA, separator=None):
    path = work_folder(spark, "csv") + "/snapshot"
    df = spark.createDataFrame(rows, schema)
    write_csv_snapshot(df.coalesce(1), path)
    return path, df


@pytest.mark.parametrize("size", [40, 333, 1 << 20])
def test_rows_are_those_of_the_other_reader(spark, split_at, size):
    rows = texts(60)
    path, df = one_file(spark, rows)
    want = sorted_rows(ks.read_csv_snapshot(spark, path, df.schema))
    split_at(size)
    lines = csv_split.raw_lines(spark, path)
    assert (lines.select("split").distinct().count() > 1) == (size < 1000)
    assert sorted_rows(ks.read_csv_snapshot(spark, path, df.schema, split=True)) == want
    assert len(want) == len(rows)


fields = st.lists(st.tuples(st.one_of(st.none(), st.text('a"\n\r, ', max_size=6)), st.one_of(st.none(), st.text('b"\n', max_size=4)), st.none()), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=fields, size=st.integers(9, 60))
def test_any_text(spark, split_at, rows, size):
    path, df = one_file(spark, [(f"k{a}" if a is not None else a, b, i) for i, (a, b, _) in enumerate(rows)])
    want = sorted_rows(ks.read_csv_snapshot(spark, path, df.schema))
    split_at(size)
    assert sorted_rows(ks.read_csv_snapshot(spark, path, df.schema, split=True)) == want


def written(spark, data):
    from pathlib import Path

    folder = Path(work_folder(spark, "csv"))
    folder.mkdir(parents=True)
    (folder / "one.csv").write_bytes(data)
    return str(folder)


@pytest.mark.parametrize("size", [5, 1000])
def test_carriage_returns_blank_lines_and_the_end(spark, split_at, size):
    data = 'k,v\r\n1,"a\r\nb"\r\n\r\n2,c\r\n3,"say ""hi"""\r\n4,"x\ny"'.encode()
    for mark in (b"", "﻿".encode()):
        path = written(spark, mark + data)
        split_at(size)
        found = ks.read_csv_snapshot(spark, path, spark.createDataFrame([], "k int, v string").schema, split=True)
        assert sorted_rows(found) == [(1, "a\r\nb"), (2, "c"), (3, 'say "hi"'), (4, "x\ny")]


def test_several_files_have_a_header_each(spark, split_at):
    path = work_folder(spark, "csv") + "/snapshot"
    df = spark.createDataFrame(texts(40, 3), SCHEMA)
    write_csv_snapshot(df.repartition(4), path)
    want = sorted_rows(ks.read_csv_snapshot(spark, path, df.schema))
    split_at(64)
    assert sorted_rows(ks.read_csv_snapshot(spark, path, df.schema, split=True)) == want
    assert csv_split.records(spark, path).filter("first").count() == 4


def test_broken_files_are_refused(spark, split_at):
    split_at(16)
    schema = spark.createDataFrame([], "k int, v string").schema
    for data, message in (
        (b'k,v\n1,"never ends\n2,b\n', "does not end"),
        (b"k,w\n1,b\n", "header"),
        (b"k,v\n1,b,c\n", "MALFORMED|malformed"),
        (b"k,v\none,b\n", "MALFORMED|malformed"),
    ):
        with pytest.raises(Exception, match=message):
            ks.read_csv_snapshot(spark, written(spark, data), schema, split=True).collect()


def test_one_file_is_read_by_many_tasks(spark, split_at):
    from compare import SF_DIR

    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    path = work_folder(spark, "csv") + "/snapshot"
    write_csv_snapshot(rows.coalesce(1), path)
    split_at(16_000)
    assert csv_split.raw_lines(spark, path).select(F.spark_partition_id()).distinct().count() > 12
    back = ks.read_csv_snapshot(spark, path, rows.schema, split=True)
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
    # A read of few columns must not lose rows.
    assert back.select("turn").count() == rows.count() and back.agg(F.sum("turn")).first() == rows.agg(F.sum("turn")).first()
