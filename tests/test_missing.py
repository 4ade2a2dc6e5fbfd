from __future__ import annotations

import pytest
from compare import SF_DIR
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import keysweep as ks
from checks import fixtures as fx
from checks import queries as q
from keysweep.functions.columns import align_keys
from keysweep.operators.missing import (
    EVEN_ROWS,
    Spread,
    flag_rows,
    key_spread,
    find_missing,
    missing_in_source,
    missing_keys,
)
from keysweep.storage import BROADCAST_LIMIT, broadcast_bytes, sized, stage, work_folder

KEYS = ["a", "b"]
TARGET = "a int, b int, v string, is_deleted string"
# With a limit of -1 nothing is broadcast, so the shuffled forms run.
LIMITS = [BROADCAST_LIMIT, -1]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(
    ("target", "source", "null_safe", "flagged"),
    [
        pytest.param((2, None), [(2, None)], False, True, id="null in key"),
        pytest.param((2, None), [(2, None)], True, False, id="null in key, null-safe"),
        pytest.param((None, None), [(None, None)], False, True, id="only nulls"),
        pytest.param((None, None), [(None, None)], True, False, id="only nulls, null-safe"),
        pytest.param((None, 0), [(0, None), (0, 0)], True, True, id="null is not zero"),
        pytest.param((1, 10), [(1, 10), (1, 10)], False, False, id="duplicate source key"),
        pytest.param((4, 40), [(4, 41)], False, True, id="partial match"),
        pytest.param((4, 40), [], False, True, id="empty source"),
    ],
)
def test_edge_keys(spark, target, source, null_safe, flagged):
    rows = spark.createDataFrame([(*target, "x", "0")], TARGET)
    keys = spark.createDataFrame(source, "a int, b int")
    expected = [(*target, "x", "0")] if flagged else []
    assert rows_of(missing_in_source(rows, keys, KEYS, null_safe)) == expected
    for limit in LIMITS:
        for even in (None, True, False):
            folder = work_folder(spark)
            found = find_missing(rows, keys, KEYS, folder, null_safe, limit, even)
            assert rows_of(found) == expected


part = st.one_of(st.none(), st.integers(0, 2))
pairs = st.lists(st.tuples(part, part), max_size=12)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    target=pairs,
    source=pairs,
    null_safe=st.booleans(),
    limit=st.sampled_from(LIMITS),
    even=st.sampled_from([True, False, None]),
)
def test_agrees_with_brute_force(spark, target, source, null_safe, limit, even):
    target = [(*key, str(i), "0") for i, key in enumerate(target)]

    def found(key):
        return key in source and (null_safe or None not in key)

    expected = sorted([row for row in target if not found(row[:2])], key=repr)
    rows = spark.createDataFrame(target, TARGET)
    keys = spark.createDataFrame(source, "a int, b int")
    assert rows_of(missing_in_source(rows, keys, KEYS, null_safe)) == expected

    folder = work_folder(spark)
    stored = even is False
    found = find_missing(rows, keys, KEYS, folder, null_safe, limit, even, stored)
    assert rows_of(found) == expected
    found_keys = missing_keys(rows, keys, KEYS, null_safe, bool(even))
    gone = sized(stage(found_keys, folder + "/gone"), limit)
    assert gone.rows.distinct().count() == gone.rows.count()
    after = flag_rows(rows, gone, KEYS, null_safe=null_safe)
    assert after.columns == rows.columns
    gone_ids = {row[2] for row in expected}
    assert rows_of(after) == sorted(
        [(a, b, v, "1" if v in gone_ids else flag) for a, b, v, flag in target], key=repr
    )


def test_anti_join_equals_flagged_left_join(spark):
    target = q.active(fx.tgt_pair(spark, SF_DIR))
    source = fx.src_pair_short(spark, SF_DIR)
    flagged = ks.left_join_flagged(target, source, fx.PAIR.keys).filter("is_deleted_new = '1'")
    via_join = flagged.drop("is_deleted").withColumnRenamed("is_deleted_new", "is_deleted")
    via_join = via_join.select(*target.columns)
    anti = ks.flag_deleted(missing_in_source(target, source, fx.PAIR.keys))
    assert anti.exceptAll(via_join).count() == 0
    assert via_join.exceptAll(anti).count() == 0


def test_flagged_left_join_has_every_target_row_once(spark):
    rows = [(1, 1, "a", "0"), (1, None, "b", "0"), (2, 2, "c", "0"), (3, 3, "d", "x")]
    target = spark.createDataFrame(rows, TARGET)
    source = spark.createDataFrame([(3, 3), (3, 3), (1, 1), (1, None)], "a int, b int")
    flagged = ks.left_join_flagged(target, source, KEYS)
    assert flagged.columns == ["a", "b", "v", "is_deleted", "is_deleted_new"]
    assert {r.v: r.is_deleted_new for r in flagged.collect()} == {"a": "0", "b": "1", "c": "1", "d": "x"}
    assert flagged.count() == 4


@pytest.mark.parametrize(
    ("query", "column", "expected"),
    [
        (q.missing_in_source_single, "id", (1038, 7788017)),
        (q.missing_in_source_pair, "transaction_id", (3257, 24210183)),
    ],
)
def test_known_sums(spark, query, column, expected):
    rows = query(spark, SF_DIR).agg(F.count(F.lit(1)), F.sum(column)).first()
    assert tuple(rows) == expected


def test_known_counts_with_null_keys(spark):
    assert q.missing_in_source_five(spark, SF_DIR).count() == 9231
    assert q.missing_in_source_five_nullsafe(spark, SF_DIR).count() == 3500


def test_hot_keys_and_hot_nulls(spark):
    """A third of the target rows holds one key, a third a NULL, and a third of the source one key."""
    target = spark.range(9000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as a",
        "id as v",
        "'0' as is_deleted",
    )
    source = spark.range(9000).selectExpr("if(id % 3 = 0, 8, id) as a").filter("a % 5 <> 2")
    present = {row.a for row in source.collect()}
    expected = sorted(r.v for r in target.collect() if r.a is None or r.a not in present)
    assert len(expected) > 6000
    assert sorted(r.v for r in missing_in_source(target, source, ["a"]).collect()) == expected
    for limit in LIMITS:
        for even in (True, False, None):
            found = find_missing(
                target, source, ["a"], work_folder(spark), broadcast_limit=limit, even=even
            )
            assert sorted(r.v for r in found.collect()) == expected


def test_key_spread(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 5, id) as a", "cast(null as int) as b")
    hot = key_spread(df, ["a"])
    assert hot.rows == 30_000
    assert 10_000 <= hot.largest_bucket <= 10_100
    assert hot.broadcast_bytes == broadcast_bytes(df.select("a"))
    assert key_spread(df, ["b"]).largest_bucket == 0
    assert key_spread(df, ["b"], null_safe=True).largest_bucket == 30_000
    assert key_spread(df.filter("false"), ["a"]) == Spread(0, 0, 0)
    assert 1 <= key_spread(spark.range(30_000), ["id"]).largest_bucket <= 12


def test_uneven_tables_are_told_from_even_ones():
    rows = 1000 * EVEN_ROWS
    assert Spread(rows, EVEN_ROWS // 2, 0).even
    assert not Spread(10**11, 2 * EVEN_ROWS, 0).even
    assert not Spread(rows, rows // 3, 0).even
    assert not Spread(rows, rows // 100, 0).even
    assert Spread(2 * EVEN_ROWS, EVEN_ROWS, 0).even


def test_column_order_is_kept(spark):
    rows = spark.createDataFrame([("x", 1, "0", 2)], "v string, a int, is_deleted string, b int")
    keys = spark.createDataFrame([(9, 9)], "a int, b int")
    for found in (
        missing_in_source(rows, keys, KEYS),
        missing_in_source(rows, keys, KEYS, null_safe=True),
        find_missing(rows, keys, KEYS, work_folder(spark)),
    ):
        assert ks.flag_deleted(found).columns == rows.columns


def test_align_keys_takes_the_types_and_names_of_the_target(spark):
    target = spark.createDataFrame([], "id bigint, code string")
    source = spark.createDataFrame([("7", 1), ("-8", 2)], "ID string, CODE int")
    aligned = align_keys(source, target.schema, ["id", "code"])
    assert aligned.dtypes == [("id", "bigint"), ("code", "string")]
    assert rows_of(aligned) == [(-8, "2"), (7, "1")]


@pytest.mark.parametrize(
    ("value", "source_type", "target_type"),
    [("x7", "string", "bigint"), (1.5, "double", "bigint"), (2**40, "bigint", "int")],
)
def test_align_keys_refuses_what_does_not_convert(spark, value, source_type, target_type):
    target = spark.createDataFrame([], f"id {target_type}")
    source = spark.createDataFrame([(value,)], f"id {source_type}")
    with pytest.raises(Exception, match="source key id is not"):
        align_keys(source, target.schema, ["id"]).collect()


def test_align_keys_refuses_fractions_as_text(spark):
    target = spark.createDataFrame([], "id string")
    with pytest.raises(ValueError, match="7 and 7.0 differ"):
        align_keys(spark.createDataFrame([], "id decimal(38,10)"), target.schema, ["id"])
    with pytest.raises(ValueError, match="no key columns"):
        align_keys(spark.createDataFrame([], "other int"), target.schema, ["id"])
