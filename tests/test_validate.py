from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import keysweep as ks
from keysweep.functions import naming
from keysweep.operators import validate
from keysweep.sinks.audit import append_audit, audit_record, counts_frame
from keysweep.storage import broadcast_bytes, row_bytes, sized, work_folder


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_equal_schemas_pass_in_any_order(spark):
    old, new = empty(spark, "a int, b string"), empty(spark, "b string, a int")
    ks.check_columns(old, new)
    ks.check_schema(old, new)


def test_all_mismatches_are_listed_in_order(spark):
    old = empty(spark, "id bigint, is_deleted int, lost string, n array<int>")
    new = empty(spark, "id bigint, is_deleted string, found string, n array<bigint>")
    ks.check_columns(old, new)
    with pytest.raises(ValueError) as raised:
        ks.check_schema(old, new)
    expected = [
        "extra column found",
        "is_deleted type mismatch (expected int, got string)",
        "missing column lost",
        "n type mismatch (expected array<int>, got array<bigint>)",
    ]
    assert str(raised.value).endswith("; ".join(expected))
    rows = validate.schema_diff(
        validate.schema_inventory(old, "t"), validate.schema_inventory(new, "t")
    )
    assert sorted(r.mismatch for r in rows.collect()) == expected


def test_column_counts(spark):
    old, new = empty(spark, "a int, z int, b int"), empty(spark, "a int, c int")
    with pytest.raises(ValueError, match=r"3 columns .* 2; missing: \['b', 'z'\], extra: \['c'\]"):
        ks.check_columns(old, new)
    inventories = [validate.schema_inventory(df, "t") for df in (old, new)]
    found = {tuple(r) for r in validate.column_diff(*inventories).collect()}
    assert found == {("t", "missing", "b"), ("t", "missing", "z"), ("t", "extra", "c")}


def test_column_diff_passes_equal_counts_and_reports_lost_tables(spark):
    old = validate.schema_inventory(empty(spark, "a int, b int"), "same").unionByName(
        validate.schema_inventory(empty(spark, "x int"), "lost")
    )
    new = validate.schema_inventory(empty(spark, "a int, c int"), "same")
    assert [tuple(r) for r in validate.column_diff(old, new).collect()] == [("lost", "missing", "x")]


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['c', 'd'\]"):
        validate.check_required(empty(spark, "a int, b int"), ["d", "a", "c"])


def test_shaping(spark):
    df = spark.createDataFrame([(1, "x", "m")], "a int, `b.c` string, _hoodie_x string")
    assert ks.drop_meta(df).columns == ["a", "b.c"]
    assert ks.stringify(df).dtypes == [("a", "string"), ("b.c", "string"), ("_hoodie_x", "string")]
    assert ks.stringify(df, ["a"]).first()["a"] == "1"
    wider = empty(spark, "new date, a bigint").schema
    assert ks.null_fill(df.select("a"), wider).first().asDict() == {"new": None, "a": 1}
    with pytest.raises(ValueError, match="b.c"):
        ks.null_fill(df, wider)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_run_time_is_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = spark.range(1).select(naming.utc_text(F.timestamp_seconds(F.lit(1706682600)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert text == "2024-01-31 06:30:00"


def test_run_time_of_now():
    shown = dt.datetime.strptime(naming.utc_now(), "%Y-%m-%d %H:%M:%S")
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - shown).total_seconds()) < 5


def test_last_audit_record_of_a_key_counts(spark):
    path = work_folder(spark, "audit") + "/audit"
    spec = ks.TableSpec("t", ("k",), ordering="o", system="s")
    for source in (5, 8):
        counts = counts_frame(spark, source, 6)
        append_audit(audit_record(counts, spec, "2024-01-01 00:00:00", f"run{source}"), path)
    append_audit(audit_record(counts_frame(spark, 1, 1), spec, "2024-01-02 00:00:00", "x"), path)
    found = {r.soft_delete_key: r for r in ks.read_audit(spark, path).collect()}
    assert len(found) == 2
    last = found["t2024-01-01 00:00:00"]
    assert (last.job_run_id, last.source_table_count, last.record_count_diff) == ("run8", 8, 2)


def test_broadcast_size_grows_with_rows_and_text(spark):
    few = spark.range(100).selectExpr("cast(id as string) as k")
    many = spark.range(1000).selectExpr("repeat('x', 50) as k")
    assert broadcast_bytes(few.filter("false")) == 0
    assert 0 < broadcast_bytes(few) < broadcast_bytes(many)
    assert broadcast_bytes(many) >= 50_000
    assert (sized(many, 10**6).hint, sized(many, 1000).hint) == ("broadcast", "merge")


def test_row_size_finds_columns_in_any_case(spark):
    df = spark.createDataFrame([("four", 1)], "ID string, N bigint")
    assert df.agg(F.sum(row_bytes(df, ["id", "n"]))).first()[0] == 48 + 2 * 16 + 4


def test_shared_folder_is_taken_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one.startswith(shared) and two.startswith(shared) and one != two


class Settings(dict):
    """Stands in for a session: only its settings are asked for."""

    @property
    def conf(self):
        return self


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Settings({"spark.master": "yarn"}))
    shared = Settings({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/shared/"})
    assert work_folder(shared, "run").startswith("hdfs://x/shared/keysweep/run-")
    assert "keysweep-" in work_folder(Settings({"spark.master": "local[2]"}))
