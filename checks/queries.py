"""One query per operator. Each takes the session and a folder of generated tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import keysweep as ks
from checks import fixtures as fx
from keysweep.functions import naming
from keysweep.functions.columns import is_active
from keysweep.operators import homes, slices, validate
from keysweep.operators.counts import SOURCE_EXCEEDS_TARGET, gate_is_open
from keysweep.operators.missing import BITMAP
from keysweep.sources import config, jdbc
from keysweep.sources.target import write_csv_snapshot
from keysweep.storage import BROADCAST_LIMIT, stage, work_folder

Query = Callable[[SparkSession, str], DataFrame]

# The run that the audited queries stand for.
RUN_TIME, RUN_ID = "2024-01-31 06:30:00", "run-1"

CONFIG = """{
  "single": {"integration": "one", "primary_keys": "id", "ordering": "last_modified"},
  "pair": {"integration": "one", "primary_keys": "transaction_id, transaction_line_id,",
           "ordering": "date_last_modified_gmt"},
  "five": {"integration": "two", "primary_keys": "k1,k2,k3,k4,,k5", "ordering": "date_last_modified"}
}"""


def active(target: DataFrame) -> DataFrame:
    return target.filter(is_active())


def published(spark: SparkSession, target: DataFrame, purpose: str) -> str:
    path = work_folder(spark, purpose) + "/table"
    ks.write_partitioned(target, path)
    return path


# Sources ---------------------------------------------------------------------------------------


def project_source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.src_single(spark, sf_dir)
    return ks.functions.columns.align_keys(source, fx.tgt_single(spark, sf_dir).schema, fx.SINGLE.keys)


def source_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the predicates of a parallel source read split the keys; each row must be in one part."""
    source = fx.src_pair(spark, sf_dir)
    predicates = jdbc.remainder_predicates(source.schema, jdbc.PARTITIONS, quote="`")
    parts = F.posexplode(F.array(*map(F.expr, predicates))).alias("part", "taken")
    return source.select(parts).filter("taken").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def source_key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds of a parallel source read split by range."""
    fx.src_pair(spark, sf_dir).createOrReplaceTempView("keysweep_source")
    return spark.sql("SELECT * FROM " + jdbc.bounds_query("keysweep_source", "transaction_id", "`"))


def quantile_parts(source: Query, spec: ks.TableSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys each part of a source read split by quantiles has: part 0 is that of keys with a NULL, the others are even."""
    view = f"keysweep_quantiles_{spec.name}"
    rows = source(spark, sf_dir)
    rows.createOrReplaceTempView(view)
    # Spark stands for the database here, and would sort all keys in one task.
    slices.key_slices(rows, spec.keys, work_folder(spark, "quantiles")).createOrReplaceTempView(f"{view}_slices")
    tiles = spark.sql("SELECT * FROM " + jdbc.quantile_query(f"{view}_slices", spec.keys, jdbc.PARTITIONS, "`", slices.SLICE))
    bounds = [row[:-1] for row in sorted(tiles.collect(), key=lambda row: row[-1])]
    predicates = jdbc.quantile_predicates(spec.keys, bounds, "`")
    parts = F.posexplode(F.array(*map(F.expr, predicates))).alias("part", "taken")
    return spark.table(view).select(parts).filter("taken").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


source_key_quantiles = partial(quantile_parts, fx.src_pair, fx.PAIR)
# Text, a hot first key, and NULLs.
source_text_quantiles = partial(quantile_parts, fx.src_text, fx.TEXT)


def csv_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = work_folder(spark, "csv") + "/snapshot"
    write_csv_snapshot(rows, path)
    return ks.read_csv_snapshot(spark, path, rows.schema)


def csv_snapshot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as one file, which the splittable reader gives to as many tasks as its size asks for."""
    rows = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = work_folder(spark, "csv") + "/snapshot"
    write_csv_snapshot(rows.coalesce(1), path)
    return ks.read_csv_snapshot(spark, path, rows.schema, split=True)


def target_active_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = published(spark, fx.tgt_single(spark, sf_dir), "active")
    return ks.read_target_active(spark, path)


def config_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration document per order, with an entry for the order and one for its customer."""
    return fx.table(spark, sf_dir, "orders").selectExpr(
        """to_json(map(
             concat('order_', o_orderkey),
             named_struct('integration', o_orderstatus,
                          'primary_keys', concat(' o', o_custkey, ',,', o_orderpriority, ' , ')),
             concat('customer_', o_orderkey),
             named_struct('integration', cast(null as string),
                          'primary_keys', if(o_orderstatus = 'F', concat('c', o_custkey), null))
           )) as value"""
    )


def table_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.config_keys(config.parse_table_config(config_documents(spark, sf_dir)))


# Columns and names -----------------------------------------------------------------------------


def flag_three_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = active(fx.tgt_single(spark, sf_dir))
    return rows.groupBy("is_deleted").agg(F.count(F.lit(1)).alias("n"))


def derived_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("env"), F.col("c_nationkey")).alias("env"),
        F.lower("c_mktsegment").alias("system"),
        F.col("c_name").alias("table_name"),
    )
    env, system, name = F.col("env"), F.col("system"), F.col("table_name")
    template = "s3://warehouse-{env}/{system}/{table}/"
    return parts.select(
        "table_name",
        naming.target_name(system, name).alias("target_name"),
        naming.database_name(env, "_replica").alias("database_name"),
        naming.target_path(template, env=env, system=system, table=name).alias("path"),
    )


def drop_meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.drop_meta(fx.tgt_single(spark, sf_dir))


def stringify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.tgt_single(spark, sf_dir).select("id", "amount", "last_modified", "is_deleted")
    return ks.stringify(rows.withColumn("amount", F.col("amount").cast("decimal(18,2)")))


def null_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fx.tgt_single(spark, sf_dir).select("id", "cust_id", "is_deleted")
    return target.unionByName(ks.null_fill(fx.src_single(spark, sf_dir), target.schema))


# Missing keys ----------------------------------------------------------------------------------


def left_join_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = ks.left_join_flagged(
        active(fx.tgt_single(spark, sf_dir)), fx.src_single(spark, sf_dir), fx.SINGLE.keys
    )
    return flagged.select("id", "is_deleted", "is_deleted_new")


def update_set(
    spec: ks.TableSpec,
    target: Query,
    source: Query,
    spark: SparkSession,
    sf_dir: str,
    null_safe: bool = False,
    by_key: bool = False,
    target_is_stored: bool = True,
) -> DataFrame:
    """The rows to flag, found in the way their sizes suggest, or by comparing keys in any case."""
    rows, keys = active(ks.drop_meta(target(spark, sf_dir))), source(spark, sf_dir)
    folder = work_folder(spark, spec.name)
    limit, even = (-1, False) if by_key else (BROADCAST_LIMIT, None)
    return ks.flag_deleted(
        ks.find_missing(
            rows, keys, spec.keys, folder, null_safe, limit, even, target_is_stored
        )
    )


def update_set_wide(
    spec: ks.TableSpec, target: Query, source: Query, spark: SparkSession, sf_dir: str
) -> DataFrame:
    """The rows to flag, as one lazy anti join of whole rows."""
    rows, keys = active(ks.drop_meta(target(spark, sf_dir))), source(spark, sf_dir)
    return ks.flag_deleted(ks.missing_in_source(rows, keys, spec.keys))


def missing_in_source_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys to flag, compared as bitmaps."""
    rows = active(fx.tgt_single(spark, sf_dir))
    return ks.missing_keys(rows, fx.src_single(spark, sf_dir), fx.SINGLE.keys, way=BITMAP)


missing_in_source_single = partial(update_set, fx.SINGLE, fx.tgt_single, fx.src_single)
# The pair target is a result of its own, the others are projections of stored tables.
missing_in_source_pair = partial(
    update_set, fx.PAIR, fx.tgt_pair, fx.src_pair, target_is_stored=False
)
missing_in_source_pair_wide = partial(update_set_wide, fx.PAIR, fx.tgt_pair, fx.src_pair)
missing_in_source_pair_by_key = partial(missing_in_source_pair, by_key=True)
missing_in_source_five = partial(update_set, fx.FIVE, fx.tgt_five, fx.src_five)
missing_in_source_five_wide = partial(update_set_wide, fx.FIVE, fx.tgt_five, fx.src_five)
missing_in_source_five_by_key = partial(missing_in_source_five, by_key=True)
missing_in_source_five_nullsafe = partial(missing_in_source_five, null_safe=True)
missing_in_source_five_nullsafe_by_key = partial(missing_in_source_five_nullsafe, by_key=True)


# Counts and gate -------------------------------------------------------------------------------


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ks.run_counts(fx.src_single(spark, sf_dir), active(fx.tgt_single(spark, sf_dir)))


def gated(
    spec: ks.TableSpec, target: Query, source: Query, spark: SparkSession, sf_dir: str
) -> DataFrame:
    rows, keys = active(target(spark, sf_dir)), source(spark, sf_dir)
    difference = ks.run_counts(keys, rows).first()["count_diff"]
    is_open = gate_is_open(difference, SOURCE_EXCEEDS_TARGET)
    update = ks.missing_in_source(rows.select(*spec.keys), keys, spec.keys)
    return update.filter(F.lit(is_open)).agg(
        F.lit(difference).cast("bigint").alias("count_diff"),
        F.lit(is_open).alias("gate_open"),
        F.count(F.lit(1)).alias("update_rows"),
    )


gate_open = partial(gated, fx.SINGLE, fx.tgt_single, fx.src_single)
gate_closed = partial(gated, fx.PAIR, fx.tgt_pair, fx.src_pair_short)


# Validation ------------------------------------------------------------------------------------


def inventories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The columns of two generations of many tables: one table per order, one column per line."""
    lines = fx.pair_latest(spark, sf_dir).selectExpr(
        "concat('order_', l_orderkey) as table_name",
        "concat('line_', l_linenumber) as column_name",
        "l_returnflag as old_type",
        "case when l_quantity > 40 then 'string' else l_returnflag end as new_type",
        "case when l_quantity < 5 then concat(column_name, '_x') else column_name end as new_name",
        "l_quantity between 10 and 12 as dropped",
    )
    old = lines.selectExpr("table_name", "column_name", "old_type as type_name")
    new = lines.filter("not dropped").selectExpr(
        "table_name", "new_name as column_name", "new_type as type_name"
    )
    return old, new


def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.column_diff(*inventories(spark, sf_dir))


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.schema_diff(*inventories(spark, sf_dir))


# Upsert and storage ----------------------------------------------------------------------------


def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.latest_event(spark, sf_dir, fx.STORED_EVENT, "base")
    incoming = fx.latest_event(spark, sf_dir, fx.INCOMING_EVENT, "update")
    return ks.upsert(stored, incoming, ["user_id"], "ts")


def upsert_keeps_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = ks.drop_meta(fx.tgt_single(spark, sf_dir))
    missing = ks.missing_in_source(active(stored), fx.src_single(spark, sf_dir), fx.SINGLE.keys)
    moved = ks.flag_deleted(missing).withColumn("partition_key", F.lit("Z"))
    merged = ks.upsert(
        stored, moved, fx.SINGLE.keys, fx.SINGLE.ordering, partition_col="partition_key"
    )
    return merged.select("id", "is_deleted", "partition_key")


def upsert_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = ks.drop_meta(fx.tgt_single(spark, sf_dir))
    path = published(spark, stored, "upsert")
    rows = ks.read_target_active(spark, path)
    missing = ks.missing_in_source(rows, fx.src_single(spark, sf_dir), fx.SINGLE.keys)
    ks.upsert_to_path(
        spark, ks.flag_deleted(missing), path, fx.SINGLE.keys, fx.SINGLE.ordering
    )
    return ks.read_target(spark, path, stored.schema)


def partitioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = published(spark, fx.tgt_single(spark, sf_dir), "publish")
    return ks.read_target(spark, path).groupBy("partition_key").agg(F.count(F.lit(1)).alias("n"))


def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = published(spark, fx.tgt_single(spark, sf_dir), "catalog")
    database = path.split("/")[-2].replace("-", "_")
    name = ks.publish_table(spark, path, database, "single", database_path=f"{path}_database")
    return spark.table(name).groupBy("partition_key").agg(F.count(F.lit(1)).alias("n"))


def latest_wins_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.pair_latest(spark, sf_dir)


# Jobs ------------------------------------------------------------------------------------------


def audit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's record, appended twice to an audit table and read back by key."""
    path = work_folder(spark, "audit") + "/audit"
    record = ks.audit_record(run_counts(spark, sf_dir), fx.SINGLE, RUN_TIME, RUN_ID)
    ks.append_audit(record.withColumn("status", F.lit("Failed")), path)
    ks.append_audit(record, path)
    return ks.read_audit(spark, path)


def soft_delete_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = published(spark, fx.tgt_pair(spark, sf_dir), "job")
    ks.reconcile(spark, fx.PAIR, fx.src_pair(spark, sf_dir), path, run_time=RUN_TIME, run_id=RUN_ID)
    stored = ks.read_target(spark, path)
    return stored.select("transaction_id", "transaction_line_id", "is_deleted", "partition_key")


def reconcile_all_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = config.parse_table_config(spark.createDataFrame([(CONFIG,)], "value string"))
    targets = {"single": fx.tgt_single, "pair": fx.tgt_pair, "five": fx.tgt_five}
    sources = {"single": fx.src_single, "pair": fx.src_pair, "five": fx.src_five}
    outcomes = ks.reconcile_all(
        spark,
        ks.table_specs(entries),
        {name: source(spark, sf_dir) for name, source in sources.items()},
        {name: published(spark, target(spark, sf_dir), name) for name, target in targets.items()},
        parallel=len(targets),
        run_time=RUN_TIME,
        run_id=RUN_ID,
    )
    return ks.summary(spark, outcomes)


def reconcile_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run that compares only the key ranges whose digests changed since the first one."""
    target = fx.tgt_pair(spark, sf_dir)
    path = published(spark, target, "digests")
    digests = f"{path}_digests"
    everything = target.select(*fx.PAIR.keys)
    for source in (everything, fx.src_pair(spark, sf_dir)):
        ks.reconcile(spark, fx.PAIR, source, path, run_time=RUN_TIME, run_id=RUN_ID, digests=digests)
    return ks.read_target(spark, path).select("transaction_id", "transaction_line_id", "is_deleted", "partition_key")


def upsert_switched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of ``upsert_soft_delete`` into a catalog table whose partitions are switched to new locations."""
    path = published(spark, ks.drop_meta(fx.tgt_single(spark, sf_dir)), "switched")
    name = ks.publish_table(spark, path, path.split("/")[-2].replace("-", "_"), "single", database_path=f"{path}_database")
    rows = ks.read_registered(spark, name).filter(is_active())
    missing = ks.missing_in_source(rows, fx.src_single(spark, sf_dir), fx.SINGLE.keys)
    ks.upsert_to_table(spark, ks.flag_deleted(missing), name, fx.SINGLE.keys, fx.SINGLE.ordering)
    return ks.read_registered(spark, name)


def upsert_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of ``upsert_soft_delete`` in two halves, which find their partitions by an index of all keys."""
    path = published(spark, ks.drop_meta(fx.tgt_single(spark, sf_dir)), "indexed")
    database = path.split("/")[-2].replace("-", "_")
    name = ks.publish_table(spark, path, database, "single", database_path=f"{path}_database")
    rows = ks.read_registered(spark, name).filter(is_active())
    missing = ks.flag_deleted(ks.missing_in_source(rows, fx.src_single(spark, sf_dir), fx.SINGLE.keys))
    update = stage(missing, f"{path}_update")
    for half in (0, 1):
        batch = update.filter(F.col("id") % 2 == half)
        ks.upsert_to_table(spark, batch, name, fx.SINGLE.keys, fx.SINGLE.ordering, index=homes.index_name(database, "single"))
    return ks.read_registered(spark, name)


def reconcile_evolved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over partitions whose older files lack a column: the rewrite must not lose it."""
    path = work_folder(spark, "evolved") + "/table"
    rows = ks.drop_meta(fx.tgt_single(spark, sf_dir))
    ks.write_partitioned(rows.filter("id % 2 = 0").drop("amount"), path)
    rows.filter("id % 2 = 1").write.mode("append").partitionBy("partition_key").option("compression", "gzip").parquet(path)
    ks.reconcile(spark, fx.SINGLE, fx.src_single(spark, sf_dir), path, run_time=RUN_TIME, run_id=RUN_ID)
    return ks.read_target(spark, path).select("id", "amount", "is_deleted", "partition_key")


def widened_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose older files hold a narrower key and fewer digits than its newer ones, read in the types that hold both."""
    folder = work_folder(spark, "widened")
    orders = fx.table(spark, sf_dir, "orders").withColumn("partition_key", F.col("o_orderstatus"))
    for key, digits, rest in (("int", "decimal(12,0)", 0), ("bigint", "decimal(16,2)", 1), ("decimal(20,0)", "decimal(14,4)", 2)):
        rows = orders.filter(F.col("o_orderkey") % 3 == rest)
        rows = rows.selectExpr(f"cast(o_orderkey as {key}) as id", f"cast(o_custkey as {digits}) as cust_id", "partition_key")
        rows.write.mode("append").partitionBy("partition_key").parquet(f"{folder}/table")
    found = ks.read_target(spark, f"{folder}/table", kept_schema=f"{folder}/schema")
    kinds = "/".join(f.dataType.simpleString() for f in found.schema)
    return found.select(F.col("id").cast("bigint"), F.col("cust_id").cast("bigint"), "partition_key", F.lit(kinds).alias("kinds"))


def reconcile_all_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table of parallel runs that share one folder and one audit path."""
    entries = config.parse_table_config(spark.createDataFrame([(CONFIG,)], "value string"))
    targets = {"single": fx.tgt_single, "pair": fx.tgt_pair, "five": fx.tgt_five}
    sources = {"single": fx.src_single, "pair": fx.src_pair, "five": fx.src_five}
    folder = work_folder(spark, "audited")
    ks.reconcile_all(
        spark,
        ks.table_specs(entries),
        {name: source(spark, sf_dir) for name, source in sources.items()},
        {name: published(spark, target(spark, sf_dir), name) for name, target in targets.items()},
        parallel=len(targets),
        run_time=RUN_TIME,
        run_id=RUN_ID,
        folder=f"{folder}/runs",
        audit_path=f"{folder}/audit",
    )
    return ks.read_audit(spark, f"{folder}/audit").select(
        "source_table_name", "source_table_count", "target_table_count", "record_count_diff", "status"
    )


QUERIES: dict[str, Query] = {
    "project_source_keys": project_source_keys,
    "source_key_parts": source_key_parts,
    "source_key_bounds": source_key_bounds,
    "source_key_quantiles": source_key_quantiles,
    "source_text_quantiles": source_text_quantiles,
    "csv_snapshot_scan": csv_snapshot_scan,
    "csv_snapshot_split": csv_snapshot_split,
    "target_active_scan": target_active_scan,
    "table_config": table_config,
    "flag_three_valued": flag_three_valued,
    "derived_names": derived_names,
    "drop_meta_columns": drop_meta_columns,
    "stringify_columns": stringify_columns,
    "null_fill_missing": null_fill_missing,
    "left_join_flagged": left_join_flagged,
    "missing_in_source_single": missing_in_source_single,
    "missing_in_source_bitmap": missing_in_source_bitmap,
    "missing_in_source_pair": missing_in_source_pair,
    "missing_in_source_pair_wide": missing_in_source_pair_wide,
    "missing_in_source_pair_by_key": missing_in_source_pair_by_key,
    "missing_in_source_five": missing_in_source_five,
    "missing_in_source_five_wide": missing_in_source_five_wide,
    "missing_in_source_five_by_key": missing_in_source_five_by_key,
    "missing_in_source_five_nullsafe": missing_in_source_five_nullsafe,
    "missing_in_source_five_nullsafe_by_key": missing_in_source_five_nullsafe_by_key,
    "run_counts": run_counts,
    "gate_open": gate_open,
    "gate_closed": gate_closed,
    "column_diff": column_diff,
    "schema_diff": schema_diff,
    "latest_wins_pair": latest_wins_pair,
    "upsert_events": upsert_events,
    "upsert_keeps_partition": upsert_keeps_partition,
    "upsert_soft_delete": upsert_soft_delete,
    "upsert_switched": upsert_switched,
    "upsert_by_index": upsert_by_index,
    "partitioned_publish": partitioned_publish,
    "catalog_publish": catalog_publish,
    "audit_record": audit_record,
    "soft_delete_end_to_end": soft_delete_end_to_end,
    "reconcile_by_digests": reconcile_by_digests,
    "reconcile_all_configured": reconcile_all_configured,
    "reconcile_evolved_files": reconcile_evolved_files,
    "widened_files_scan": widened_files_scan,
    "reconcile_all_audited": reconcile_all_audited,
}
