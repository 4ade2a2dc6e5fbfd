from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import keysweep as ks
from keysweep.sources import config, jdbc
from keysweep.sources.target import write_csv_snapshot
from keysweep.storage import work_folder

PASSWORD = jdbc.password_profile("one", "example.Driver")
TOKEN = jdbc.token_profile("two", "example.TokenDriver")
SECRETS = {
    "connectionUrl": "jdbc:x:1", "username": "u", "password": "p", "db_url": "jdbc:y:2",
    "account_id": "a", "consumer_key": "ck", "consumer_secret": "cs", "token_id": "t",
    "token_secret": "ts",
}
SPEC = ks.TableSpec("lines", ("id", "line"), ordering="o")


def test_password_profile_options():
    assert jdbc.connection_options(PASSWORD, SECRETS) == {
        "url": "jdbc:x:1", "user": "u", "password": "p", "driver": "example.Driver",
        "fetchsize": "10000",
    }


def test_token_profile_options():
    assert jdbc.connection_options(TOKEN, SECRETS) == {
        "url": "jdbc:y:2", "account_id": "a", "consumer_key": "ck", "consumer_secret": "cs",
        "token_id": "t", "token_secret": "ts", "driver": "example.TokenDriver",
        "fetchsize": "10000",
    }


def test_unknown_profiles_and_absent_settings_are_named():
    with pytest.raises(ValueError, match="unknown source profile 'three'"):
        jdbc.profile_named({"one": PASSWORD, "two": TOKEN}, "three")
    assert jdbc.profile_named({"one": PASSWORD}, "one") is PASSWORD
    with pytest.raises(ValueError, match=r"lacks settings: \['password', 'username'\]"):
        jdbc.connection_options(PASSWORD, {"connectionUrl": "jdbc:x:1"})


def test_identifiers_are_quoted():
    assert jdbc.key_query("transaction", ["id", 'a"b']) == (
        '(SELECT "id", "a""b" FROM "transaction") subq'
    )
    assert jdbc.key_query("s.t", ["id"], "`") == "(SELECT `id` FROM `s`.`t`) subq"
    assert jdbc.key_query("t", ["id"], "") == "(SELECT id FROM t) subq"
    with pytest.raises(ValueError, match="needs quoting"):
        jdbc.key_query("t; drop table u", ["id"], "")


def test_connections_follow_the_source():
    assert [jdbc.connections(n) for n in (0, 1_000_000, 1_000_001, 10_000_001, 3 * 10**9)] == [1, 1, 10, 11, 3000]
    assert [jdbc.connections(n, 4) for n in (5, 10**9)] == [1, 4]


@pytest.mark.parametrize("partitions", [1, 7, 10])
def test_remainder_predicates_cover_every_row_once(spark, partitions):
    big = 2**63
    ids = [None, 0, 1, -1, 5, -5, 12, big - 1, -big, 10**12, -(10**12) - 3]
    rows = [(a, b) for a in ids for b in (None, 0, 3, -4, 2**31 - 1, -(2**31))]
    df = spark.createDataFrame(rows, "id bigint, line int")
    predicates = jdbc.remainder_predicates(df.schema, partitions, "`")
    assert len(predicates) == partitions
    hits = sum(F.expr(p).cast("int") for p in predicates)
    assert {r.n for r in df.select(hits.alias("n")).collect()} == {1}


def test_remainders_spread_rows_that_share_a_key(spark):
    df = spark.range(1000).selectExpr("cast(42 as bigint) as id", "cast(id as int) as line")
    predicates = jdbc.remainder_predicates(df.schema, 10, "`")
    assert [df.filter(p).count() for p in predicates] == [100] * 10


def test_remainders_need_an_integer_key():
    def schema(*types):
        return T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate(types)])

    assert jdbc.remainder_predicates(schema(T.StringType(), T.DecimalType(10, 2)), 4) is None
    assert jdbc.remainder_predicates(schema(T.StringType(), T.DecimalType(38, 0)), 2) == [
        'MOD(ABS(MOD(COALESCE("c1", 0), 2)), 2) = 0',
        'MOD(ABS(MOD(COALESCE("c1", 0), 2)), 2) = 1',
    ]


class Reader:
    """Stands in for ``spark.read``: records the reads and returns frames by their query."""

    def __init__(self, frames, log, chosen=()):
        self.frames, self.log, self.chosen = frames, log, dict(chosen)

    @property
    def read(self):
        return Reader(self.frames, self.log)

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        return Reader(self.frames, self.log, {**self.chosen, **options})

    def load(self):
        self.log.append(self.chosen)
        query = self.chosen["dbtable"]
        return self.frames["bounds" if "MIN(" in query else "count" if "COUNT(" in query else "keys"]

    def jdbc(self, url, table, predicates, properties):
        self.log.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self.frames["keys"]


def read(spark, count, key_type="bigint", bounds=(3, 90, 60), spec=SPEC, **kwargs):
    log = []
    columns = [f"{key.upper()} {kind}" for key, kind in zip(spec.keys, (key_type, "int"))]
    frames = {
        "keys": spark.createDataFrame([], ", ".join(columns)),
        "bounds": spark.createDataFrame([bounds], "lo bigint, hi bigint, n bigint"),
        "count": spark.createDataFrame([(count,)], "n bigint"),
    }
    # A target of one row must not decide how a large source is read.
    rows = jdbc.read_source_keys(Reader(frames, log), spec, PASSWORD, SECRETS, 1, **kwargs)
    assert log.pop(0)["dbtable"] == f'(SELECT COUNT(*) AS n FROM "{spec.name}") subq'
    assert rows.columns == list(spec.keys)
    return log


ONE_KEY = ks.TableSpec("heads", ("id",), ordering="o")


def test_small_source_is_read_over_one_connection(spark):
    (options,) = read(spark, 1_000_000)
    assert options["dbtable"] == '(SELECT "id", "line" FROM "lines") subq'
    assert "partitionColumn" not in options


@pytest.mark.parametrize("choice", [{"spec": ONE_KEY}, {"split": "range"}])
def test_dense_single_key_or_choice_splits_by_range(spark, choice):
    options = read(spark, 1_000_001, **choice)[-1]
    parts = {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert parts == {
        "partitionColumn": "ID", "lowerBound": "3", "upperBound": "90", "numPartitions": "10",
    }


def test_gaps_and_composite_keys_split_by_remainder(spark):
    assert len(read(spark, 2_000_000, spec=ONE_KEY, bounds=(1, 1000, 400))[-1]["predicates"]) == 10
    log = read(spark, 2_000_000)
    assert len(log[-1]["predicates"]) == 10
    assert not any("MIN(" in options["dbtable"] for options in log)


def test_one_connection_remains_where_nothing_splits(spark):
    options = read(spark, 2_000_000, key_type="string", spec=ONE_KEY)[-1]
    assert "predicates" not in options and "partitionColumn" not in options
    empty = read(spark, 2_000_000, key_type="double", spec=ONE_KEY, bounds=(None, None, 0))[-1]
    assert "predicates" not in empty and "partitionColumn" not in empty
    assert "partitionColumn" in read(spark, 2_000_000, key_type="double", spec=ONE_KEY)[-1]


def test_other_integer_keys_split_text_keys(spark):
    options = read(spark, 2_000_000, key_type="string")[-1]
    assert len(options["predicates"]) == 10
    assert "LINE" in options["predicates"][0] and "ID" not in options["predicates"][0]


def test_split_by_remainder(spark):
    options = read(spark, 2_000_000, split="remainder", partitions=4)[-1]
    assert len(options["predicates"]) == 4
    assert (options["url"], options["user"], options["fetchsize"]) == ("jdbc:x:1", "u", "10000")
    with pytest.raises(ValueError, match="unknown split"):
        read(spark, 2_000_000, split="halves")


def test_options_reach_the_jdbc_reader(spark):
    """Without the driver on the class path the reader names the class it was given."""
    with pytest.raises(Exception, match="example.Driver"):
        ks.read_source_keys(spark, SPEC, PASSWORD, SECRETS, 10)


def test_jdbc_source_checks_its_profile_first(spark):
    profiles = {"one": PASSWORD}
    with pytest.raises(ValueError, match="unknown source profile None"):
        ks.jdbc_source(spark, SPEC, profiles, SECRETS)
    spec = ks.TableSpec("lines", ("id", "line"), ordering="o", profile="one")
    with pytest.raises(ValueError, match="lacks settings"):
        ks.jdbc_source(spark, spec, profiles, {})
    log = []
    frames = {"keys": spark.createDataFrame([(1, 2)], "ID bigint, LINE int"), "count": spark.createDataFrame([(1,)], "n bigint")}
    source = ks.jdbc_source(Reader(frames, log), spec, profiles, SECRETS)
    assert log == []
    assert [tuple(row) for row in source(5).collect()] == [(1, 2)]
    assert len(log) == 2


def test_csv_keeps_quotes_line_breaks_blanks_and_zeros(spark):
    rows = [
        ("007", 'say "hi", ok', 1), ("1.10", "two\nlines\r\nand more", 2), ("", " padded ", 3),
        (None, "", None), ("x", None, 5), ("a\\b", '\\"', 6),
    ]
    df = spark.createDataFrame(rows, "k string, v string, n int")
    path = work_folder(spark, "csv") + "/snapshot"
    write_csv_snapshot(df, path)
    back = ks.read_csv_snapshot(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_csv_of_another_shape_is_refused(spark):
    df = spark.createDataFrame([("a", "b")], "k string, v string")
    path = work_folder(spark, "csv") + "/snapshot"
    write_csv_snapshot(df, path)
    with pytest.raises(Exception):
        ks.read_csv_snapshot(spark, path, df.select("v", "k").schema).collect()
    numbers = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    with pytest.raises(Exception):
        ks.read_csv_snapshot(spark, path, numbers).collect()


def test_partition_values_stay_text(spark):
    df = spark.createDataFrame([(1, "007"), (2, "1"), (3, None), (4, "a/b=c")], "k int, partition_key string")
    path = work_folder(spark, "t") + "/table"
    ks.write_partitioned(df, path)
    back = ks.read_target(spark, path)
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0


def test_table_exists(spark):
    assert not ks.table_exists(spark, "no_such_db", "t")
    assert not ks.table_exists(spark, "default", "no_such_table")


ENTRIES = {
    "lines": {"integration": "one", "primary_keys": "id,line", "ordering": "o", "system": "s"},
    "blanks": {"integration": "two", "primary_keys": "a, b,,\t"},
    "keyless": {"integration": "two"},
    "bare": {"primary_keys": "x"},
}


def config_file(folder, text):
    file = folder / "tables.json"
    file.write_text(text)
    return str(file)


def test_table_config_file(spark, tmp_path):
    read = ks.read_table_config(spark, config_file(tmp_path, json.dumps(ENTRIES, indent=2)))
    found = {r.table_name: (r.integration, r.primary_keys) for r in read.collect()}
    assert found == {
        "lines": ("one", ["id", "line"]), "blanks": ("two", ["a", "b"]),
        "keyless": ("two", []), "bare": (None, ["x"]),
    }
    keys = {(r.table_name, r.key_pos, r.key_name) for r in config.config_keys(read).collect()}
    assert keys == {
        ("lines", 0, "id"), ("lines", 1, "line"), ("blanks", 0, "a"), ("blanks", 1, "b"),
        ("bare", 0, "x"),
    }
    specs = {spec.name: spec for spec in ks.table_specs(read)}
    assert specs["lines"] == ks.TableSpec("lines", ("id", "line"), "o", "s", "one")
    template = "s3://warehouse-{env}/{system}/{table}/"
    assert specs["lines"].path(template, env="dev") == "s3://warehouse-dev/s/lines/"
    assert (specs["lines"].target_name, specs["lines"].record_key) == ("s_lines", "id,line")
    with pytest.raises(ValueError, match="no primary key"):
        specs["keyless"].check()
    with pytest.raises(ValueError, match="no ordering"):
        specs["bare"].check()


def test_malformed_config_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ks.read_table_config(spark, config_file(tmp_path, '{"a": {"primary_keys": ')).collect()
