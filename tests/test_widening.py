"""Files that disagree on types: the common schema, its limits, and what is kept of it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import keysweep as ks
from keysweep.sources import widening

SIMPLE = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.DateType(),
    T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.DecimalType(20, 18),
]


@given(st.sampled_from(SIMPLE), st.sampled_from(SIMPLE))
def test_order_does_not_matter(left, right):
    assert widening.wider(left, right) == widening.wider(right, left)
    assert widening.wider(left, left) == left


@pytest.mark.parametrize(
    "left, right, both",
    [
        ("int", "bigint", "bigint"),
        ("float", "double", "double"),
        ("int", "double", "double"),
        ("bigint", "double", None),
        ("int", "float", None),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(38,0)", "decimal(10,2)", None),
        ("bigint", "decimal(10,2)", "decimal(22,2)"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", None),
        ("int", "string", None),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("struct<a:int,b:string>", "struct<a:bigint,c:int>", "struct<a:bigint,b:string,c:int>"),
        ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_least_type(spark, left, right, both):
    found = widening.wider(T.DataType.fromDDL(left), T.DataType.fromDDL(right))
    assert found == (both and T.DataType.fromDDL(both))


def write(spark, path, kind, values, part):
    rows = spark.createDataFrame([(str(v) if v is not None else None, part) for v in values], "v string, partition_key string")
    rows.select(F.col("v").cast(kind).alias("v"), "partition_key").coalesce(1).write.mode("append").partitionBy("partition_key").parquet(path)


@pytest.mark.parametrize(
    "narrow, low, wide, high, both",
    [
        ("int", [1, -(2**31), None], "bigint", [2**60], "bigint"),
        ("smallint", [-7], "int", [2**31 - 1], "int"),
        ("float", ["0.5"], "double", ["0.1"], "double"),
        ("int", [2**31 - 1], "double", ["0.25"], "double"),
        ("decimal(6,2)", ["1234.56"], "decimal(20,4)", ["1234567890123456.7891"], "decimal(20,4)"),
        ("int", [2**31 - 1], "decimal(14,4)", ["0.0625"], "decimal(14,4)"),
        ("bigint", [2**63 - 1], "decimal(10,2)", ["0.25"], "decimal(22,2)"),
    ],
)
@pytest.mark.parametrize("turned", [False, True])
def test_values_are_kept(spark, tmp_path, narrow, low, wide, high, both, turned):
    path = str(tmp_path / "t")
    parts = [(narrow, low, "007"), (wide, high, "b")]
    for kind, values, part in reversed(parts) if turned else parts:
        write(spark, path, kind, values, part)
    found = ks.read_target(spark, path)
    assert found.schema["v"].dataType == T.DataType.fromDDL(both)
    exact = {"double": float}.get(both, Decimal)
    got = sorted((r.partition_key, r.v if r.v is None else exact(r.v)) for r in found.filter("v is not null").collect())
    assert got == sorted([("007", exact(str(v))) for v in low if v is not None] + [("b", exact(str(v))) for v in high])
    assert found.filter("v is null").count() == low.count(None)
    # A filter on the wider type finds rows of narrower files.
    assert found.filter(F.col("v") == F.lit(str(low[0])).cast(both)).count() == 1


def test_lossy_mix_is_refused_by_file(spark, tmp_path):
    path = str(tmp_path / "t")
    for kind, part in (("int", "a"), ("bigint", "b"), ("string", "c"), ("bigint", "d")):
        write(spark, path, kind, [1], part)
    with pytest.raises(ValueError, match="column v: bigint and string: .*partition_key=a.* and .*partition_key=c"):
        ks.read_target(spark, path)


def test_many_changes_and_added_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(6):
        kind = ("int", "bigint", "decimal(24,2)")[k % 3]
        rows = spark.range(k, k + 1).selectExpr(f"cast(id as {kind}) as v", f"id as c{k}", "'x' as partition_key")
        rows.write.mode("append").partitionBy("partition_key").parquet(path)
    found = ks.read_target(spark, path)
    assert set(found.columns) == {"v", *(f"c{k}" for k in range(6)), "partition_key"}
    assert sorted(int(r.v) for r in found.collect()) == list(range(6))
    assert found.agg(*[F.count(f"c{k}") for k in range(6)]).first() == (1,) * 6


def test_other_failures_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ks.read_target(spark, str(tmp_path / "none"))


def test_only_new_files_are_read_for_their_schema(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    looked = []
    real = widening.merged
    monkeypatch.setattr(widening, "merged", lambda s, base, files, part: looked.append(len(files)) or real(s, base, files, part))
    for k in range(3):
        write(spark, path, "int", [k], f"p{k}")
    assert ks.read_target(spark, path, kept_schema=kept).schema["v"].dataType == T.IntegerType()
    assert looked == [3]
    assert ks.read_target(spark, path, kept_schema=kept).count() == 3 and looked == [3]
    write(spark, path, "bigint", [2**40], "p9")
    found = ks.read_target(spark, path, kept_schema=kept)
    assert looked == [3, 1] and found.schema["v"].dataType == T.LongType()
    assert sorted(r.v for r in found.collect()) == [0, 1, 2, 2**40]
    # What a write left behind that died is not trusted.
    (tmp_path / "kept" / "version-000000009" / "_temporary").mkdir(parents=True)
    assert ks.read_target(spark, path, kept_schema=kept).count() == 4 and sum(looked[2:]) >= 4
    write(spark, path, "bigint", [5], "p9")
    del looked[:]
    assert ks.read_target(spark, path, kept_schema=kept).count() == 5
    assert ks.read_target(spark, path, kept_schema=kept).count() == 5
    write(spark, path, "string", ["x"], "p9")
    for _ in range(2):
        with pytest.raises(ValueError, match="known to"):
            ks.read_target(spark, path, kept_schema=kept)


def test_a_run_over_widened_files(spark, tmp_path):
    """Flags are set in files of either width, and the rewritten partitions have the wider type."""
    path = str(tmp_path / "t")
    for kind, ids, part in (("int", (1, 2, 3), "a"), ("bigint", (2**40, 2**40 + 1), "b")):
        rows = spark.createDataFrame([(i, dt.date(2024, 1, 1), "0", part) for i in ids], "id long, at date, is_deleted string, partition_key string")
        rows.withColumn("id", F.col("id").cast(kind)).write.mode("append").partitionBy("partition_key").parquet(path)
    source = spark.createDataFrame([(1,), (3,), (2**40,)], "id long")
    ks.reconcile(spark, ks.TableSpec("t", ("id",), ordering="at"), source, path)
    found = {r.id: r.is_deleted for r in ks.read_target(spark, path).collect()}
    assert found == {1: "0", 2: "1", 3: "0", 2**40: "0", 2**40 + 1: "1"}
