"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from compare import SF_DIR

import keysweep as ks
from checks import fixtures as fx
from checks import queries as q
from keysweep.operators.missing import flag_rows, missing_keys, rows_with_keys
from keysweep.storage import sized, stage, work_folder


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range|round)", text))


@pytest.fixture
def pair(spark):
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(fx.tgt_pair(spark, SF_DIR), path)
    source = stage(fx.src_pair(spark, SF_DIR), work_folder(spark, "s") + "/keys")
    return path, source


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def read_columns(text: str) -> list[set[str]]:
    """The columns that each file scan reads, without partition columns."""
    return [
        set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", text)
    ]


def test_flag_filter_reaches_the_scan(spark, pair):
    text = plan(ks.read_target_active(spark, pair[0]))
    assert "PushedFilters: [IsNotNull(is_deleted), Not(EqualTo(is_deleted,1))]" in text


def test_comparison_reads_and_shuffles_keys_only(spark, pair, no_broadcast):
    path, source = pair
    text = plan(missing_keys(ks.read_target_active(spark, path), source, fx.PAIR.keys))
    keys = set(fx.PAIR.keys)
    assert read_columns(text) == [keys | {"is_deleted"}, keys]
    assert shuffles(text) == 1
    assert "Join" not in text and "SortAggregate" not in text
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_comparison_of_even_sides_is_a_join_of_keys(spark, pair, no_broadcast):
    path, source = pair
    target = ks.read_target_active(spark, path)
    text = plan(missing_keys(target, source, fx.PAIR.keys, even=True))
    keys = set(fx.PAIR.keys)
    assert read_columns(text) == [keys | {"is_deleted"}, keys]
    assert "LeftAnti" in text
    assert len(re.findall(r"Sort \[[^\n]*\n[^\n]*Exchange hashpartitioning", text)) == 2


def test_small_update_set_moves_no_target_row(spark, pair):
    path, source = pair
    stored = ks.read_target(spark, path)
    gone = missing_keys(ks.read_target_active(spark, path), source, fx.PAIR.keys)
    gone = sized(stage(gone, work_folder(spark) + "/gone"))
    for df in (
        flag_rows(stored, gone, fx.PAIR.keys),
        rows_with_keys(stored, gone, fx.PAIR.keys),
        rows_with_keys(stored, gone, fx.PAIR.keys, null_safe=True),
    ):
        text = plan(df)
        assert "BroadcastHashJoin" in text and shuffles(text) == 0


def test_large_update_set_is_merged_in_a_form_whose_skew_is_split(spark, pair):
    path, source = pair
    stored = ks.read_target(spark, path)
    gone = missing_keys(ks.read_target_active(spark, path), source, fx.PAIR.keys)
    gone = sized(stage(gone, work_folder(spark) + "/gone"), -1)
    for df in (flag_rows(stored, gone, fx.PAIR.keys), rows_with_keys(stored, gone, fx.PAIR.keys)):
        text = plan(df)
        assert "SortMergeJoin" in text and "Broadcast" not in text
        # Spark splits skewed partitions of joins whose sides are sorted right after their shuffles.
        assert len(re.findall(r"Sort \[[^\n]*\n[^\n]*Exchange hashpartitioning", text)) == 2


def test_partitions_are_pruned(spark, pair):
    from keysweep.functions.columns import in_values

    text = plan(ks.read_target(spark, pair[0]).filter(in_values("partition_key", ["A", None])))
    assert re.search(r"PartitionFilters: \[\(?[^\]]*partition_key", text)


def test_latest_row_is_picked_before_the_shuffle(spark):
    text = plan(fx.pair_latest(spark, SF_DIR))
    assert shuffles(text) == 1
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_lazy_upsert_shuffles_the_stored_rows_once(spark):
    stored = fx.table(spark, SF_DIR, "orders")
    merged = ks.upsert(stored, stored.limit(10), ["o_orderkey"], "o_orderdate")
    text = plan(merged)
    assert "Join" not in text
    assert shuffles(text.split("Union", 1)[0]) == 1


@pytest.mark.parametrize("name", q.QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(q.QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("form", [ks.missing_in_source, ks.left_join_flagged])
def test_skew_of_whole_row_joins_is_split_at_run_time(spark, no_broadcast, form):
    """A third of the target rows holds one key, and a third of the source rows another."""
    target = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 7, id) as a", "cast(id as string) as v", "'0' as is_deleted"
    )
    source = spark.range(300_000).selectExpr("if(id % 3 = 0, 8, id) as a")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = form(target, source, ["a"])
        rows = found.collect()
        assert "skew=true" in plan(found)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(rows) == (300_000 if form is ks.left_join_flagged else 0)
