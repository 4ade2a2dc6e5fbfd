from __future__ import annotations

from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import keysweep as ks
from keysweep.sources.target import read_target
from keysweep.storage import BROADCAST_LIMIT, work_folder

SCHEMA = "k int, o int, v string, p string"
LIMITS = [BROADCAST_LIMIT, -1]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def at_path(spark, stored, incoming, limit=BROADCAST_LIMIT, **kwargs):
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(stored, path, "p")
    ks.upsert_to_path(
        spark, incoming, path, ["k"], "o", partition_col="p", broadcast_limit=limit, **kwargs
    )
    return read_target(spark, path, stored.schema, "p")


def everywhere(spark, stored, incoming):
    """The result of all forms, which must agree."""
    results = [rows_of(ks.upsert(stored, incoming, ["k"], "o", partition_col="p"))]
    results += [rows_of(at_path(spark, stored, incoming, limit)) for limit in LIMITS]
    assert results[0] == results[1] == results[2]
    return results[0]


@pytest.mark.parametrize(
    ("stored", "incoming", "expected"),
    [
        pytest.param((1, 5, "old", "A"), (1, 5, "new", "A"), (1, 5, "new", "A"), id="tie"),
        pytest.param((1, 10, "old", "A"), (1, 9, "new", "A"), (1, 10, "old", "A"), id="older"),
        pytest.param((1, 9, "old", "A"), (1, 10, "new", "A"), (1, 10, "new", "A"), id="newer"),
        pytest.param((1, 9, "old", "A"), (1, 9, "new", "B"), (1, 9, "new", "A"), id="partition kept"),
        pytest.param((1, 9, "old", None), (1, 9, "new", "B"), (1, 9, "new", None), id="null partition"),
        pytest.param((1, None, "old", "A"), (1, 1, "new", "A"), (1, 1, "new", "A"), id="stored null"),
        pytest.param((1, 1, "old", "A"), (1, None, "new", "A"), (1, 1, "old", "A"), id="incoming null"),
        pytest.param((1, None, "o", "A"), (1, None, "n", "A"), (1, None, "n", "A"), id="both null"),
        pytest.param((None, 1, "o", "A"), (None, 1, "n", "A"), (None, 1, "n", "A"), id="null key"),
    ],
)
def test_one_key(spark, stored, incoming, expected):
    other = (7, 1, "other", "A")
    before = spark.createDataFrame([stored, other], SCHEMA)
    after = everywhere(spark, before, spark.createDataFrame([incoming], SCHEMA))
    assert after == sorted([expected, other], key=repr)


def test_empty_partition_text_is_null(spark):
    stored = spark.createDataFrame([(1, 1, "a", None), (2, 1, "b", "A")], SCHEMA)
    incoming = spark.createDataFrame([(3, 1, "c", "")], SCHEMA)
    for limit in LIMITS:
        after = rows_of(at_path(spark, stored, incoming, limit))
        assert after == [(1, 1, "a", None), (2, 1, "b", "A"), (3, 1, "c", None)]


def test_partition_values_that_need_escaping(spark):
    names = ["a/b=c", "x y%", "007", "7", "Ä'\"", "a:b"]
    stored = spark.createDataFrame([(i, 1, "old", p) for i, p in enumerate(names)], SCHEMA)
    incoming = spark.createDataFrame([(i, 2, "new", "Z") for i in range(len(names))], SCHEMA)
    assert everywhere(spark, stored, incoming) == [(i, 2, "new", p) for i, p in enumerate(names)]


def test_new_keys_and_repeated_incoming_keys(spark):
    stored = spark.createDataFrame([(1, 1, "a", "A")], SCHEMA)
    incoming = spark.createDataFrame(
        [(2, 1, "x", "B"), (2, 3, "y", "C"), (2, 2, "z", "A"), (1, 0, "late", "B")], SCHEMA
    )
    assert everywhere(spark, stored, incoming) == [(1, 1, "a", "A"), (2, 3, "y", "C")]


def test_columns_the_batch_lacks_become_null(spark):
    stored = spark.createDataFrame([(1, 1, "a", "A")], SCHEMA)
    incoming = spark.createDataFrame([("A", 2, 1), ("B", 2, 5)], "p string, o int, k int")
    assert everywhere(spark, stored, incoming) == [(1, 2, None, "A"), (5, 2, None, "B")]


def test_columns_the_table_lacks_are_refused(spark):
    stored = spark.createDataFrame([(1, 1, "a", "A")], SCHEMA)
    incoming = spark.createDataFrame([(1, 1, "a", "A", 3)], SCHEMA + ", extra int")
    with pytest.raises(ValueError, match="extra"):
        ks.upsert(stored, incoming, ["k"], "o")


def test_ordering_stored_as_text_is_compared_as_a_number(spark):
    schema = "k int, o string, v string, p string"
    stored = spark.createDataFrame([(1, "9", "old", "A"), (2, "10", "old", "A")], schema)
    incoming = spark.createDataFrame([(1, "10", "new", "A"), (2, "9", "new", "A")], schema)
    expected = [(1, "10", "new", "A"), (2, "10", "old", "A")]
    assert rows_of(ks.upsert(stored, incoming, ["k"], "o", "bigint")) == expected
    for limit in LIMITS:
        assert rows_of(at_path(spark, stored, incoming, limit, ordering_type="bigint")) == expected


@pytest.mark.parametrize("key", [1, None])
def test_repeated_stored_keys_are_refused_when_written_to(spark, key):
    stored = spark.createDataFrame([(key, 1, "a", "A"), (key, 1, "b", "B"), (3, 1, "c", "A")], SCHEMA)
    hit = spark.createDataFrame([(key, 2, "new", "A")], SCHEMA)
    with pytest.raises(Exception, match="not unique by k"):
        ks.upsert(stored, hit, ["k"], "o").collect()
    with pytest.raises(ValueError, match="not unique by k"):
        at_path(spark, stored, hit)
    untouched = everywhere(spark, stored, spark.createDataFrame([(3, 2, "n", "A")], SCHEMA))
    assert untouched == sorted(
        [(key, 1, "a", "A"), (key, 1, "b", "B"), (3, 2, "n", "A")], key=repr
    )


def test_only_touched_partitions_are_rewritten(spark):
    stored = spark.createDataFrame([(i, 1, "v", "ABC"[i % 3]) for i in range(30)], SCHEMA)
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(stored, path, "p")

    def files(partition):
        return sorted(p.name for p in Path(path, f"p={partition}").glob("*.parquet"))

    before = {p: files(p) for p in "ABC"}
    assert all(name.endswith(".gz.parquet") for names in before.values() for name in names)
    incoming = spark.createDataFrame([(0, 2, "new", "A")], SCHEMA)
    assert ks.upsert_to_path(spark, incoming, path, ["k"], "o", partition_col="p") == 1
    assert files("A") != before["A"]
    assert (files("B"), files("C")) == (before["B"], before["C"])
    assert all(name.endswith(".gz.parquet") for name in files("A"))
    assert read_target(spark, path, stored.schema, "p").count() == 30


def test_empty_batch_changes_nothing(spark):
    stored = spark.createDataFrame([(1, 1, "a", "A")], SCHEMA)
    assert everywhere(spark, stored, stored.filter("k > 5")) == [(1, 1, "a", "A")]


key = st.one_of(st.none(), st.integers(0, 3))
order = st.one_of(st.none(), st.integers(0, 2))
row = st.tuples(key, order, st.sampled_from("xyz"), st.sampled_from(["A", "B", None]))


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    stored=st.lists(row, max_size=5, unique_by=lambda r: r[0]),
    incoming=st.lists(row, max_size=8),
)
def test_agrees_with_brute_force(spark, stored, incoming):
    def rank(r):
        return (r[1] is not None, r[1] or 0, r[2], r[3] is not None, r[3] or "")

    expected = {r[0]: r for r in stored}
    latest = {}
    for r in incoming:
        if r[0] not in latest or rank(r) > rank(latest[r[0]]):
            latest[r[0]] = r
    for k, r in latest.items():
        old = expected.get(k)
        if old is None:
            expected[k] = r
        elif rank(r)[:2] >= rank(old)[:2]:
            expected[k] = (*r[:3], old[3])
    before = spark.createDataFrame(stored, SCHEMA)
    after = spark.createDataFrame(incoming, SCHEMA)
    assert rows_of(ks.upsert(before, after, ["k"], "o", partition_col="p")) == sorted(
        expected.values(), key=repr
    )
    if stored:
        everywhere(spark, before, after)


def test_latest_wins_does_not_depend_on_distribution(spark):
    rows = [(i % 4, i % 3, f"v{i % 5}", "A") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    results = {
        tuple(rows_of(ks.latest_wins(d, ["k"], "o")))
        for d in (df, df.repartition(7), df.orderBy("v").coalesce(1), df.repartition(3, "v"))
    }
    assert len(results) == 1
    assert [r[:2] for r in results.pop()] == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_latest_wins_with_one_hot_key(spark):
    df = spark.range(6000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as o")
    expected = {i: i for i in range(6000) if i % 3} | {0: 5997}
    assert {r.k: r.o for r in ks.latest_wins(df, ["k"], "o").collect()} == expected
