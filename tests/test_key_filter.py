"""Large update sets: rows whose key cannot be in them skip the joins, and nothing else changes."""

from __future__ import annotations

import pytest
from compare import SF_DIR
from pyspark.sql import functions as F

import keysweep as ks
from checks import fixtures as fx
from keysweep.operators.key_filter import MAY_HOLD, WORD_BYTES, block_bytes, key_filter
from keysweep.operators.missing import flag_rows, rows_with_keys
from keysweep.plans import reconcile as plans
from keysweep.storage import sized, stage, work_folder

# Room for all bits, for one word only, which fills up, and for a few.
LIMITS = [1 << 26, WORD_BYTES, 5 * WORD_BYTES]
KINDS = {
    "numbers": ("if(id % 50 = 7, null, id % 900) as a, cast(id % 3 as int) as b", "a bigint, b int"),
    "texts": ("if(id % 50 = 7, null, 'k' || id % 900) as a, date_add(date'2024-01-01', int(id % 3)) as b", "a string, b date"),
    "doubles": ("if(id % 50 = 7, null, if(id % 4 = 0, -0.0d, id / 7d)) as a, if(id % 8 = 0, double('nan'), 0d) as b", "a double, b double"),
    "wider than stored": ("if(id % 50 = 7, null, int(id % 900)) as a, cast(id % 3 as smallint) as b", "a bigint, b decimal(20,0)"),
}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_without_a_filter(spark, kind, limit, null_safe):
    columns, gone_types = KINDS[kind]
    flag = "case when id % 11 = 0 then '1' when id % 13 = 0 then null else '0' end as is_deleted"
    stored = spark.sql(f"select id as v, {columns}, {flag} from range(2000)")
    stored = stage(stored, work_folder(spark, "stored"))
    # Keys of a join hold plain zeros, whatever the sign of the stored ones.
    keys = stored.filter("v % 10 < 3").select("a", "b")
    keys = keys if null_safe else keys.dropna()
    cast = [F.col(name).cast(kind_) for name, kind_ in (part.split(" ", 1) for part in gone_types.split(", "))]
    gone = sized(stage(keys.select(*[c.alias(n) for c, n in zip(cast, "ab")]).distinct(), work_folder(spark, "gone")), -1)
    likely = key_filter(gone.rows, stored.schema, ["a", "b"], work_folder(spark, "filter"), limit)
    assert likely.words.count() * WORD_BYTES <= limit
    args = (stored, gone, ["a", "b"])
    assert rows_of(rows_with_keys(*args, null_safe, likely)) == rows_of(rows_with_keys(*args, null_safe))
    for null_is_active in (False, True):
        plain = flag_rows(*args, "is_deleted", null_safe, null_is_active)
        found = flag_rows(*args, "is_deleted", null_safe, null_is_active, likely, "b")
        assert found.schema.simpleString() == plain.schema.simpleString()
        assert rows_of(found) == rows_of(plain)


def test_few_rows_go_through_the_join(spark):
    stored = spark.range(100_000).selectExpr("id * 7919 as a", "id % 5 as b", "'0' as is_deleted")
    gone = stage(stored.filter("a % 20 = 0").select("a", "b"), work_folder(spark, "gone"))
    likely = key_filter(gone, stored.schema, ["a", "b"], work_folder(spark, "filter"))
    seen = likely.mark(stored).filter(MAY_HOLD)
    assert seen.join(gone, ["a", "b"], "left_semi").count() == gone.count() == 5000
    assert seen.count() < 14_000


def test_bits_of_many_keys_do_not_fill_up(spark):
    stored = spark.range(1_000_000).selectExpr("id * 7919 as a")
    gone = stage(stored.filter("a % 10 = 0"), work_folder(spark, "gone"))
    # Room for all bits in blocks; in rows of one word each, there were three bits for a key.
    likely = key_filter(gone, stored.schema, ["a"], work_folder(spark, "filter"), 400_000)
    assert likely.bits >= 16 * gone.count() and likely.words.count() * block_bytes(likely.block_bits) <= 400_000
    seen = likely.mark(stored).filter(MAY_HOLD)
    assert seen.join(gone, "a", "left_semi").count() == gone.count() == 100_000
    assert seen.count() < 170_000


def test_no_filter_where_equal_texts_differ_or_there_is_no_room(spark):
    plain = spark.range(9).selectExpr("string(id) as a")
    other = plain.selectExpr("a collate UTF8_LCASE as a")
    assert key_filter(other, other.schema, ["a"], work_folder(spark, "filter")) is None
    assert key_filter(plain, plain.schema, ["a"], work_folder(spark, "filter"), WORD_BYTES - 1) is None
    none = key_filter(plain.limit(0), plain.schema, ["a"], work_folder(spark, "filter"))
    assert none.mark(plain).filter(MAY_HOLD).count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_a_run_with_many_missing_keys_does_not_shuffle_all_rows(spark, monkeypatch, null_safe):
    written = []

    def overwrite(rows, *args, gather=False, **kwargs):
        written.append((rows._jdf.queryExecution().optimizedPlan().toString(), gather))
        return original(rows, *args, gather=gather, **kwargs)

    original = plans.overwrite_partitions
    monkeypatch.setattr(plans, "overwrite_partitions", overwrite)
    found = []
    for limit in (1 << 26, 10 * WORD_BYTES):
        path = work_folder(spark, "t") + "/table"
        ks.write_partitioned(fx.tgt_five(spark, SF_DIR), path)
        options = ks.Options(broadcast_limit=limit, null_safe_keys=null_safe)
        outcome = ks.reconcile(spark, fx.FIVE, fx.src_five(spark, SF_DIR), path, options=options)
        found.append((outcome.flagged_count, rows_of(ks.read_target(spark, path))))
    assert found[0] == found[1] and found[0][0] > 0
    (small, _), (large, gather) = written
    assert "Join" in small and "Rebalance" not in small
    # Rows are gathered below the union, where the join has scattered them, and not as a whole.
    assert not gather and large.startswith("Union") and "RebalancePartitions" in large
