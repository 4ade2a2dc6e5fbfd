"""The audit table: one record per run, put by its key. Each put writes a new folder, so that runs can record in parallel, and
the record that it replaces stays until the new one is there; of several of one key the last one written counts."""

from __future__ import annotations

import hashlib
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.naming import audit_key
from keysweep.operators.latest import latest_wins
from keysweep.sinks.files import child_folders, delete_folder, holds_files
from keysweep.spec import TableSpec

# States of a run, and the fields of its record.
COMPLETED, SKIPPED, FAILED = "Completed", "Skipped", "Failed"
SCHEMA = (
    "soft_delete_key string, source_table_name string, target_table_name string, "
    "source_table_count bigint, target_table_count bigint, record_count_diff bigint, "
    "status string, last_run_ts string, job_run_id string"
)
FIELDS = [field.split()[0] for field in SCHEMA.split(", ")]
# Nanoseconds at which a record was put; kept in its file, as files may be written anew.
_WRITTEN = "written_at"
_STORED = f"{SCHEMA}, {_WRITTEN} bigint"
_COMPACTED = "compacted-"


def audit_record(
    counts: DataFrame, spec: TableSpec, run_time: str, run_id: str, status: str = COMPLETED
) -> DataFrame:
    """The record of a run whose ``run_counts`` are given."""
    return counts.select(
        audit_key(F.lit(spec.name), F.lit(run_time)).alias("soft_delete_key"),
        F.lit(spec.name).alias("source_table_name"),
        F.lit(spec.target_name).alias("target_table_name"),
        F.col("source_count").alias("source_table_count"),
        F.col("target_count").alias("target_table_count"),
        F.col("count_diff").alias("record_count_diff"),
        F.lit(status).alias("status"),
        F.lit(run_time).alias("last_run_ts"),
        F.lit(run_id).alias("job_run_id"),
    )


def counts_frame(spark: SparkSession, source: int | None, target: int | None) -> DataFrame:
    """Counts that are already known, in the form of ``run_counts``."""
    difference = None if source is None or target is None else source - target
    return spark.createDataFrame(
        [(source, target, difference)], "source_count bigint, target_count bigint, count_diff bigint"
    )


def append_audit(record: DataFrame, path: str) -> None:
    """Put the record, which replaces one of the same key."""
    for row in record.collect():
        folder = hashlib.sha256((row.soft_delete_key or "").encode()).hexdigest()
        put = record.sparkSession.createDataFrame([(*[row[c] for c in FIELDS], time.time_ns())], _STORED)
        put.coalesce(1).write.parquet(f"{path.rstrip('/')}/{folder}/{uuid4().hex}")


def _last(records: DataFrame) -> DataFrame:
    # Files of older versions do not say when; their own time does.
    own = F.unix_micros("_metadata.file_modification_time") * 1000
    written = records.select(*FIELDS, F.coalesce(F.col(_WRITTEN), own).alias(_WRITTEN))
    return latest_wins(written, ["soft_delete_key"], _WRITTEN)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The records by key, of each the one that was put last."""
    return _last(spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(path)).drop(_WRITTEN)


def compact_audit(spark: SparkSession, path: str) -> None:
    """Write the records that count to one folder, and delete those that were there before. Runs may put theirs meanwhile."""
    older = []
    for folder in child_folders(spark, path):
        # Older versions put the files of a key in its folder itself, and a compaction leaves none in it.
        older += [folder] if holds_files(spark, folder) else child_folders(spark, folder)
    if not older:
        return
    # Only what is listed is read, so nothing is deleted that was put later.
    records = spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(*older)
    _last(records).repartition(1).write.parquet(f"{path.rstrip('/')}/{_COMPACTED}{uuid4().hex}")
    for place in older:
        delete_folder(spark, place)
