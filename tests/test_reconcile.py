from __future__ import annotations

from pathlib import Path

import pytest
from compare import SF_DIR
from pyspark.sql import functions as F

import keysweep as ks
from checks import fixtures as fx
from keysweep.functions.columns import align_keys
from keysweep.operators.counts import SOURCE_EXCEEDS_TARGET, gate_is_open
from keysweep.plans.reconcile import Options, reconcile, reconcile_all
from keysweep.sources.target import read_target
from keysweep.storage import work_folder

SPEC = ks.TableSpec("t", ("k",), ordering="o", system="sys")
SCHEMA = "k int, o int, v string, is_deleted string, partition_key string, _hoodie_meta string"
ROWS = [
    (1, 1, "a", "0", "A", "m"),
    (2, 1, "b", "0", "A", "m"),
    (3, 1, "c", "1", "B", "m"),
    (4, 1, "d", None, "B", "m"),
    (None, 1, "e", "0", "C", "m"),
    (6, 1, "f", "", "D", "m"),
    (7, 1, "g", "0", "D", "m"),
    (8, 1, "h", "0", None, "m"),
]
LENIENT = Options(max_delete_fraction=1.0)


@pytest.fixture
def target(spark):
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(spark.createDataFrame(ROWS, SCHEMA), path)
    return path


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


def flags(spark, path):
    return {row.v: row.is_deleted for row in read_target(spark, path).collect()}


def flagged_by(spark, path, before=ROWS):
    old = {row[2]: row[3] for row in before}
    return {v for v, flag in flags(spark, path).items() if flag != old[v]}


def test_flags_missing_rows_and_keeps_the_rest(spark, target):
    outcome = reconcile(spark, SPEC, keys(spark, 1, 6, 6, 9), target, options=LENIENT)
    assert flagged_by(spark, target) == {"b", "e", "g", "h"}
    assert (outcome.status, outcome.flagged_count) == ("Completed", 4)
    assert (outcome.source_count, outcome.target_count) == (4, 6)
    assert sorted(r.k for r in outcome.missing_keys.collect()) == [2, 7, 8]
    after = {tuple(r[c] for c in ("k", "o", "v", "partition_key", "_hoodie_meta"))
             for r in read_target(spark, target).collect()}
    assert after == {(k, o, v, p, m) for k, o, v, _, p, m in ROWS}


@pytest.mark.parametrize("limit", [-1, 64 * 2**20])
@pytest.mark.parametrize(
    ("null_safe", "null_flag", "expected"),
    [
        (False, False, {"b", "e", "g"}),
        (True, False, {"b", "g"}),
        (False, True, {"b", "d", "e", "g"}),
        (True, True, {"b", "d", "g"}),
    ],
)
def test_null_options(spark, target, null_safe, null_flag, expected, limit):
    options = Options(
        max_delete_fraction=1.0,
        null_safe_keys=null_safe,
        null_flag_is_active=null_flag,
        broadcast_limit=limit,
    )
    source = keys(spark, 1, 6, 8, None)
    outcome = reconcile(spark, SPEC, source, target, options=options)
    assert flagged_by(spark, target) == expected
    assert outcome.flagged_count == len(expected)


def test_second_run_finds_nothing(spark, target):
    source = keys(spark, 1, 6)
    assert reconcile(spark, SPEC, source, target, options=LENIENT).flagged_count == 4
    again = reconcile(spark, SPEC, source, target, options=LENIENT)
    assert (again.flagged_count, again.status) == (0, "Skipped")


def test_untouched_partitions_keep_their_files(spark, target):
    def files():
        return {str(p) for p in Path(target).glob("partition_key=*/*.parquet")}

    before = files()
    reconcile(spark, SPEC, keys(spark, 1, 6, 7, 8), target, options=LENIENT)
    assert flagged_by(spark, target) == {"b", "e"}
    kept = before & files()
    assert {Path(p).parent.name for p in kept} == {
        "partition_key=B", "partition_key=D", "partition_key=__HIVE_DEFAULT_PARTITION__"
    }


def test_gate_boundary():
    assert not gate_is_open(0, SOURCE_EXCEEDS_TARGET)
    assert gate_is_open(1, SOURCE_EXCEEDS_TARGET)
    assert gate_is_open(-5)
    with pytest.raises(ValueError, match="unknown gate"):
        gate_is_open(1, "never")


def test_closed_gate_changes_nothing_and_completes(spark, target):
    options = Options(gate=SOURCE_EXCEEDS_TARGET)
    outcome = reconcile(spark, SPEC, keys(spark, 1, 6), target, options=options)
    assert flagged_by(spark, target) == set()
    assert (outcome.status, outcome.flagged_count, outcome.missing_keys) == ("Completed", 0, None)


def test_open_gate_flags(spark, target):
    options = Options(gate=SOURCE_EXCEEDS_TARGET, max_delete_fraction=1.0)
    reconcile(spark, SPEC, keys(spark, 1, 6, *range(20, 30)), target, options=options)
    assert flagged_by(spark, target) == {"b", "e", "g", "h"}


def test_dry_run_counts_but_does_not_write(spark, target):
    options = Options(max_delete_fraction=1.0, dry_run=True)
    outcome = reconcile(spark, SPEC, keys(spark, 1), target, options=options)
    assert (outcome.flagged_count, outcome.status) == (5, "Skipped")
    assert flagged_by(spark, target) == set()


def test_empty_source_is_refused_and_audited(spark, target):
    audit = work_folder(spark, "audit") + "/audit"
    with pytest.raises(ValueError, match="6 of 6 active rows"):
        reconcile(
            spark, SPEC, keys(spark), target, audit_path=audit, run_time="2024-01-01 00:00:00",
            options=Options(max_delete_fraction=0.5),
        )
    assert flagged_by(spark, target) == set()
    record = ks.read_audit(spark, audit).first()
    assert (record.status, record.source_table_count, record.target_table_count) == ("Failed", 0, 6)
    assert record.record_count_diff == -6


def test_empty_target(spark):
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(spark.createDataFrame([r for r in ROWS if r[3] == "1"], SCHEMA), path)
    outcome = reconcile(spark, SPEC, keys(spark, 1), path)
    assert (outcome.target_count, outcome.flagged_count, outcome.status) == (0, 0, "Skipped")


def test_source_function_is_given_the_active_count_and_read_once(spark, target):
    calls = []

    def source(active):
        calls.append(active)
        return keys(spark, 1, 6, 7, 8)

    reconcile(spark, SPEC, source, target, options=LENIENT)
    assert calls == [6]


def test_failing_source_is_audited(spark, target):
    audit = work_folder(spark, "audit") + "/audit"

    def source(active):
        raise RuntimeError("no connection")

    with pytest.raises(RuntimeError, match="no connection"):
        reconcile(spark, SPEC, source, target, audit_path=audit)
    record = ks.read_audit(spark, audit).first()
    assert (record.status, record.source_table_count, record.target_table_count) == ("Failed", None, 6)


def test_audit_record_of_a_run(spark, target):
    audit = work_folder(spark, "audit") + "/audit"
    reconcile(
        spark, SPEC, keys(spark, 1, 6, 7), target, audit_path=audit, options=LENIENT,
        run_time="2024-02-03 04:05:06", run_id="r1",
    )
    assert ks.read_audit(spark, audit).first().asDict() == {
        "soft_delete_key": "t2024-02-03 04:05:06",
        "source_table_name": "t",
        "target_table_name": "sys_t",
        "source_table_count": 3,
        "target_table_count": 6,
        "record_count_diff": -3,
        "status": "Completed",
        "last_run_ts": "2024-02-03 04:05:06",
        "job_run_id": "r1",
    }


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"keys": ()}, "no primary key"),
        ({"keys": ("k", "k")}, "repeats"),
        ({"ordering": None}, "no ordering column"),
        ({"ordering": "absent"}, r"absent: \['absent'\]"),
        ({"flag_col": "gone"}, r"absent: \['gone'\]"),
    ],
)
def test_unfit_tables_are_refused_before_the_source_is_read(spark, target, changes, message):
    spec = ks.TableSpec(**{"name": "t", "keys": ("k",), "ordering": "o", **changes})

    def source(active):
        raise AssertionError("the source was read")

    with pytest.raises(ValueError, match=message):
        reconcile(spark, spec, source, target)


def test_published_table_is_required_and_refreshed(spark, target):
    with pytest.raises(ValueError, match="nowhere.sys_t does not exist"):
        reconcile(spark, SPEC, keys(spark, 1), target, database="nowhere")
    name = ks.publish_table(
        spark, target, "replica_db", "sys_t", database_path=work_folder(spark, "db") + "/db"
    )
    assert ks.table_exists(spark, "replica_db", "sys_t")
    assert dict(spark.table(name).dtypes)["partition_key"] == "string"
    assert spark.table(name).filter("is_deleted = '1'").count() == 1
    reconcile(spark, SPEC, keys(spark, 1, 6), target, database="replica_db", options=LENIENT)
    assert spark.table(name).filter("is_deleted = '1'").count() == 5
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 5


def test_pair_table_end_to_end(spark):
    path = work_folder(spark, "t") + "/table"
    target = fx.tgt_pair(spark, SF_DIR)
    ks.write_partitioned(target, path)
    source = fx.src_pair(spark, SF_DIR)
    assert reconcile(spark, fx.PAIR, source, path).flagged_count == 3257
    after = read_target(spark, path, target.schema)
    assert after.count() == 45832
    active = after.filter("is_deleted <> '1'").select(*fx.PAIR.keys)
    assert active.exceptAll(source).count() == 0
    assert after.drop("is_deleted").exceptAll(target.drop("is_deleted")).count() == 0
    assert reconcile(spark, fx.PAIR, source, path).flagged_count == 0


def test_flagging_in_place_equals_upserting_the_update_set(spark):
    target = ks.drop_meta(fx.tgt_single(spark, SF_DIR))
    source = fx.src_single(spark, SF_DIR)
    paths = [work_folder(spark, "t") + "/table" for _ in range(2)]
    for path in paths:
        ks.write_partitioned(target, path)
    reconcile(spark, fx.SINGLE, source, paths[0])
    active = ks.read_target_active(spark, paths[1])
    update = ks.flag_deleted(ks.missing_in_source(active, source, fx.SINGLE.keys))
    assert ks.upsert_to_path(spark, update, paths[1], fx.SINGLE.keys, fx.SINGLE.ordering) == 1038
    one, two = (read_target(spark, path, target.schema) for path in paths)
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    per_flag = {r.is_deleted: r.n for r in one.groupBy("is_deleted").agg(F.count("*").alias("n")).collect()}
    assert per_flag == {None: 141, "0": 12457, "1": 2402}


@pytest.mark.parametrize("parallel", [1, 3])
def test_all_tables_are_run_and_errors_are_raised_at_the_end(spark, parallel):
    paths = {}
    for name in ("good", "bad", "late"):
        paths[name] = work_folder(spark, name) + "/table"
        ks.write_partitioned(spark.createDataFrame(ROWS, SCHEMA), paths[name])
    specs = [ks.TableSpec(name, ("k",), ordering="o") for name in paths]
    sources = {"good": keys(spark, 1, 6, 7, 8), "bad": keys(spark), "late": keys(spark, 1, 2, 6, 7)}
    with pytest.raises(ExceptionGroup) as raised:
        reconcile_all(spark, specs, sources, paths, parallel=parallel, options=Options(max_delete_fraction=0.5))
    assert len(raised.value.exceptions) == 1
    assert raised.value.exceptions[0].__notes__ == ["table bad"]
    assert flagged_by(spark, paths["good"]) == {"b", "e"}
    assert flagged_by(spark, paths["bad"]) == set()
    assert flagged_by(spark, paths["late"]) == {"e", "h"}


def test_all_tables_are_checked_before_the_first_run(spark, target):
    specs = [SPEC, ks.TableSpec("u", ("k",), ordering="o")]
    with pytest.raises(ValueError, match="no source or no path is given for table u"):
        reconcile_all(spark, specs, {"t": keys(spark, 1)}, {"t": target})
    assert flagged_by(spark, target) == set()


def test_the_limit_guards_neither_the_parity_gate_nor_dry_runs(spark, target):
    dry = reconcile(spark, SPEC, keys(spark), target, options=Options(max_delete_fraction=0.1, dry_run=True))
    assert dry.flagged_count == 6
    rest = keys(spark, *range(100, 110))
    options = Options(max_delete_fraction=0.1, gate=SOURCE_EXCEEDS_TARGET)
    assert reconcile(spark, SPEC, rest, target, options=options).flagged_count == 6


def test_parallel_runs_share_a_folder_and_an_audit_table(spark):
    base = work_folder(spark, "many")
    specs = [ks.TableSpec(f"t{k}", ("id",), "at") for k in range(8)]
    rows = spark.range(40).selectExpr("id", "id as at", "'0' as is_deleted", "'p' || id % 2 as partition_key")
    for spec in specs:
        ks.write_partitioned(rows, f"{base}/{spec.name}")
    sources = {s.name: spark.range(40).filter(f"id <> {k} and id <> 20") for k, s in enumerate(specs)}
    paths = {s.name: f"{base}/{s.name}" for s in specs}
    outcomes = ks.reconcile_all(spark, specs, sources, paths, parallel=8, folder=f"{base}/runs", audit_path=f"{base}/audit")
    for k, outcome in enumerate(outcomes):
        assert {r.id for r in outcome.missing_keys.collect()} == {k, 20}
        flagged = ks.read_target(spark, paths[f"t{k}"]).filter("is_deleted = '1'")
        assert {r.id for r in flagged.collect()} == {k, 20}
    assert ks.read_audit(spark, f"{base}/audit").filter("status = 'Completed'").count() == 8


def test_outcomes_of_the_other_tables_come_with_the_errors(spark, target):
    other = ks.TableSpec("other", ("id",), "at")
    with pytest.raises(ExceptionGroup) as raised:
        ks.reconcile_all(
            spark, [SPEC, other], {SPEC.name: keys(spark, 1), "other": keys(spark, 1)}, {SPEC.name: target, "other": "/no/such/folder"}
        )
    assert [o.spec.name for o in raised.value.outcomes] == [SPEC.name]


def test_a_run_that_cannot_be_recorded_says_what_it_changed(spark, target, tmp_path):
    (tmp_path / "audit").write_text("a file, not a folder")
    with pytest.raises(Exception) as raised:
        reconcile(spark, SPEC, keys(spark, 1), target, audit_path=str(tmp_path / "audit"))
    assert any("was changed" in note for note in raised.value.__notes__)


@pytest.mark.parametrize("newer_first", [True, False])
def test_columns_of_some_files_survive_both_rewrites(spark, newer_first):
    path = work_folder(spark, "t") + "/table"
    old = spark.range(10).selectExpr("id", "id as at", "'0' as is_deleted", "'p' as partition_key")
    new = spark.range(10, 20).selectExpr("id", "id as at", "id * 2 as extra", "'0' as is_deleted", "'p' as partition_key")
    for rows in (new, old) if newer_first else (old, new):
        rows.coalesce(1).write.mode("append").partitionBy("partition_key").parquet(path)
    spec = ks.TableSpec("t", ("id",), "at")
    reconcile(spark, spec, spark.range(1, 20), path)
    ks.upsert_to_path(spark, spark.createDataFrame([(3, 99)], "id long, at long"), path, ["id"], "at")
    found = {r.id: r for r in ks.read_target(spark, path).collect()}
    assert found[0].is_deleted == "1" and found[3].at == 99
    assert {i: r.extra for i, r in found.items()} == {i: i * 2 if i >= 10 else None for i in range(20)}


def test_rows_that_lack_a_column_are_not_written(spark):
    from keysweep.operators.validate import check_written

    df = spark.createDataFrame([(1, "a")], "id int, v string")
    check_written(df, df.schema)
    for other in (df.drop("v"), df.withColumn("w", df["v"]), df.withColumn("id", df["id"].cast("long"))):
        with pytest.raises(ValueError, match="differ from the table"):
            check_written(other, df.schema)


def test_a_known_table_elsewhere_is_refused(spark):
    base = work_folder(spark, "c")
    rows = spark.createDataFrame([(1, "p")], "id int, partition_key string")
    ks.write_partitioned(rows, f"{base}/one")
    ks.write_partitioned(rows.withColumn("more", rows["id"]), f"{base}/two")
    database = "elsewhere"
    ks.publish_table(spark, f"{base}/one", database, "t", database_path=f"{base}/db")
    ks.publish_table(spark, f"{base}/one", database, "t")
    with pytest.raises(ValueError, match="is registered at"):
        ks.publish_table(spark, f"{base}/two", database, "t")
    rows.withColumn("more", rows["id"]).write.mode("append").partitionBy("partition_key").parquet(f"{base}/one")
    with pytest.raises(ValueError, match="without the columns"):
        ks.publish_table(spark, f"{base}/one", database, "t")


@pytest.mark.parametrize(
    ("value", "have", "want"),
    [
        ("'1.239'", "string", "decimal(10,2)"), ("timestamp_ntz'2024-01-01 10:00:00'", "timestamp_ntz", "date"),
        ("'2024-01-01 10:00:00'", "string", "date"), ("'007'", "string", "int"), ("7.5", "double", "int"),
    ],
)
def test_keys_that_lose_something_are_refused(spark, value, have, want):
    source = spark.sql(f"select cast({value} as {have}) as k")
    target = spark.sql(f"select cast(null as {want}) as k")
    with pytest.raises(Exception, match="source key k is not"):
        align_keys(source, target.schema, ["k"]).collect()


@pytest.mark.parametrize(
    ("value", "have", "want"),
    [
        ("'1.23'", "string", "decimal(10,3)"), ("timestamp_ntz'2024-01-01 00:00:00'", "timestamp_ntz", "date"),
        ("'2024-01-01'", "string", "date"), ("'7'", "string", "int"), ("7", "int", "string"), ("7.0", "double", "int"),
        ("'2024-01-01T10:00:00'", "string", "timestamp_ntz"), ("null", "string", "int"),
    ],
)
def test_exact_key_conversions(spark, value, have, want):
    source = spark.sql(f"select cast({value} as {have}) as k")
    target = spark.sql(f"select cast(null as {want}) as k")
    assert align_keys(source, target.schema, ["k"]).count() == 1
    align_keys(source, target.schema, ["k"]).collect()


def test_latest_row_of_a_table_with_maps(spark):
    df = spark.sql("select 1 as k, 1 as o, map('a', 1) as m union all select 1, 1, map('a', 2)")
    assert [r.m for r in ks.latest_wins(df, ["k"], "o").collect()] == [{"a": 2}]
