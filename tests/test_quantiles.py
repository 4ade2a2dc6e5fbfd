"""Source reads split by quantiles: every row in one part, even parts, few scans."""

from __future__ import annotations

import datetime
import random
import re
import string
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_sources import PASSWORD, SECRETS, Reader

import keysweep as ks
from keysweep.operators import slices
from keysweep.sources import jdbc
from keysweep.storage import work_folder

DAY = datetime.date(2024, 1, 1)


def part_sizes(spark, df, keys, parts):
    """Rows by part, and how often rows are in no part or in several, when Spark itself stands for the database."""
    df.createOrReplaceTempView("quantile_source")
    tiles = spark.sql("SELECT * FROM " + jdbc.quantile_query("quantile_source", keys, parts, "`")).collect()
    predicates = jdbc.quantile_predicates(keys, [row[:-1] for row in sorted(tiles, key=lambda row: row[-1])], "`")
    hits = F.array(*[F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates])
    counted = df.select(hits.alias("hits")).select(
        F.aggregate("hits", F.lit(0), lambda a, b: a + b).alias("n"), (F.array_position("hits", 1) - 1).cast("int").alias("part")
    )
    rows = counted.groupBy("n", "part").count().collect()
    assert {r.n for r in rows} <= {1}
    return {r.part: r["count"] for r in rows}


def even(sizes, parts):
    rest = [n for part, n in sizes.items() if part]
    return max(rest, default=0) <= max(1, -(-2 * sum(rest) // parts))


CASES = {
    "gaps": ("id bigint", lambda r: [(int(10 ** r.uniform(0, 15)),) for _ in range(900)]),
    "negative": ("id bigint", lambda r: [(n,) for n in range(-500, 400)]),
    "hot first part": ("a bigint, b int", lambda r: [(7 if n % 3 else n, n) for n in range(900)]),
    "hot parts, NULLs": ("a string, b string, c bigint", lambda r: [("x", None if n % 50 == 0 else "y" if n % 2 else str(n), n) for n in range(900)]),
    "text": ("code string", lambda r: [("".join(r.choice(string.printable + "é'\\") for _ in range(r.randint(0, 6))) + str(n),) for n in range(700)]),
    "decimals": ("a decimal(20,4), b date", lambda r: [(Decimal(r.randint(-(10**9), 10**9)).scaleb(-4), DAY + datetime.timedelta(n)) for n in range(500)]),
    "times": ("t timestamp", lambda r: [(datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=7919 * n * n),) for n in range(600)]),
    "doubles": ("x double", lambda r: [(r.gauss(0, 1e9),) for _ in range(500)]),
    "few": ("id int", lambda r: [(3,), (5,)]),
    "none": ("id int", lambda r: []),
    "only NULL": ("id int", lambda r: [(None,), (None,)]),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("parts", [1, 7, 30])
def test_parts_are_even_and_whole(spark, name, parts):
    schema, rows = CASES[name]
    rows = rows(random.Random(2))
    df = spark.createDataFrame(rows, schema)
    sizes = part_sizes(spark, df, df.columns, parts)
    assert sum(sizes.values()) == len(rows)
    assert len(sizes) <= parts + 1
    assert sizes.get(0, 0) == sum(None in row for row in rows)
    assert even(sizes, parts)


def tiles_of(spark, df, parts, slice_rows, folder):
    slices.key_slices(df, df.columns, folder, slice_rows).createOrReplaceTempView("quantile_slices")
    return spark.sql("SELECT * FROM " + jdbc.quantile_query("quantile_slices", df.columns, parts, "`", slices.SLICE))


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("parts", [1, 1000])
def test_slices_give_the_bounds_of_one_sort(spark, name, parts):
    schema, rows = CASES[name]
    df = spark.createDataFrame(rows(random.Random(3)), schema).repartition(3)
    df.createOrReplaceTempView("quantile_source")
    whole = spark.sql("SELECT * FROM " + jdbc.quantile_query("quantile_source", df.columns, parts, "`"))
    sliced = tiles_of(spark, df, parts, 100, work_folder(spark, "slices"))
    assert sliced.schema.simpleString() == whole.schema.simpleString()
    assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.collect()))


def test_no_task_sorts_all_keys(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr("id * 7919 % 20011 as a", "string(id) as b")
    found = tiles_of(spark, df, 10, 1000, work_folder(spark, "slices"))
    assert [row.tile for row in sorted(found.collect())] == list(range(1, 11))
    sizes = [row["count"] for row in spark.table("quantile_slices").groupBy(slices.SLICE).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3000
    # What is ordered without partitions has a row for each slice.
    query = jdbc.quantile_query("quantile_slices", df.columns, 10, "`", slices.SLICE)
    windows = re.findall(r"OVER \((.*?)\)", query)
    assert windows and all(w in ("", f"ORDER BY `{slices.SLICE}`") or w.startswith(f"PARTITION BY `{slices.SLICE}` ") for w in windows)


def test_slices_of_hot_text_keys_are_even(spark):
    """Half of the keys share their first part, as those of ``source_text_quantiles`` do; keys with a NULL are in no slice."""
    code = "case when id % 2 = 0 then 'it''s' when id % 53 = 0 then null else 'p' || id % 7 end as code"
    df = spark.range(0, 20_000, 1, 4).selectExpr(code, "cast(id / 4 as decimal(18, 2)) as line", "date_add(date'2024-01-01', int(id % 9)) as day")
    found = tiles_of(spark, df, 10, 1000, work_folder(spark, "slices")).collect()
    assert sorted(row.tile for row in found) == list(range(1, 11))
    sizes = [row["count"] for row in spark.table("quantile_slices").groupBy(slices.SLICE).count().collect()]
    assert sum(sizes) == df.filter("code is not null").count() and max(sizes) < 3000


keys = st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.sampled_from(["", "a", "b'", "c"]))), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=keys, parts=st.integers(1, 6))
def test_every_row_is_in_one_part(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b string")
    assert sum(part_sizes(spark, df, ["a", "b"], parts).values()) == len(rows)


def test_predicates_are_ranges_of_the_first_key():
    single = jdbc.quantile_predicates(["id"], [(1,), (5,), (9,)])
    assert single == [
        '"id" IS NULL', '"id" IS NOT NULL AND "id" <= 5 AND "id" < 5',
        '"id" IS NOT NULL AND "id" >= 5 AND "id" <= 9 AND "id" < 9', '"id" IS NOT NULL AND "id" >= 9',
    ]
    pair = jdbc.quantile_predicates(["a", "b"], [(1, "x"), (2, "it's")])
    assert pair[2].startswith("\"a\" IS NOT NULL AND \"b\" IS NOT NULL AND \"a\" >= 2 AND (\"a\" > 2 OR (\"a\" = 2 AND \"b\" >= 'it''s'))")


class Database(Reader):
    """Counts how often the source is scanned: by its count, its bounds, and the parts of one read."""

    def load(self):
        query = self.chosen["dbtable"]
        if "NTILE(" in query:
            self.log.append(self.chosen)
            return self.frames["tiles"]
        return super().load()

    @property
    def read(self):
        return Database(self.frames, self.log)

    def options(self, **options):
        return Database(self.frames, self.log, {**self.chosen, **options})


def read(spark, count, **kwargs):
    log = []
    frames = {
        "keys": spark.createDataFrame([], "ID string, LINE int"),
        "count": spark.createDataFrame([(count,)], "n bigint"),
        "tiles": spark.createDataFrame([("b", 2, 2), ("a", 1, 1), ("c", 0, 3)], "id string, line int, tile int"),
    }
    spec = ks.TableSpec("lines", ("id", "line"), ordering="o")
    rows = jdbc.read_source_keys(Database(frames, log), spec, PASSWORD, SECRETS, 1, **kwargs)
    assert rows.columns == ["id", "line"]
    return log


@pytest.mark.parametrize("count", [10_000_001, 10**9, 10**11])
def test_large_sources_are_scanned_a_fixed_number_of_times(spark, count):
    log = read(spark, count)
    scans = [options for options in log if "COUNT(" in options["dbtable"] or "NTILE(" in options["dbtable"]]
    assert len(scans) == 2 and f"NTILE({-(-count // 10**6)})" in scans[1]["dbtable"]
    assert [p for p in log[-1]["predicates"] if "MOD(" in p] == []
    assert log[-1]["predicates"] == jdbc.quantile_predicates(["id", "line"], [("a", 1), ("b", 2), ("c", 0)])


def test_quantiles_by_choice(spark):
    assert len(read(spark, 2_000_000, split="quantile", partitions=4)[-1]["predicates"]) == 4
    assert "MOD(" in read(spark, 2_000_000)[-1]["predicates"][0]
