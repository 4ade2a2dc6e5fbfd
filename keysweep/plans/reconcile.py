"""The soft-delete job: for one table, or for all configured tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.columns import align_keys, column, drop_meta, in_values, is_active
from keysweep.functions.naming import utc_now
from keysweep.operators.counts import ALWAYS, GATES, check_delete_fraction, gate_is_open
from keysweep.operators import digests as dg
from keysweep.operators.key_filter import KeyFilter, key_filter
from keysweep.operators.missing import (
    BROADCAST,
    flag_deleted,
    flag_rows,
    measured,
    missing_keys,
    rows_with_keys,
    stage_keys,
    way_of,
)
from keysweep.operators.validate import check_columns, check_required, check_schema, check_written
from keysweep.sinks.audit import (
    COMPLETED,
    FAILED,
    SKIPPED,
    append_audit,
    audit_record,
    counts_frame,
)
from keysweep.sinks.publish import overwrite_partitions
from keysweep.sinks.swap import read_registered, registered_name, swap_partitions
from keysweep.sources.target import read_target, require_table
from keysweep.spec import TableSpec
from keysweep.storage import BROADCAST_LIMIT, Sized, stage, stage_sized, work_folder

log = logging.getLogger(__name__)

# A source is its rows, or a function that reads them once the number of active target rows is known.
Source = DataFrame | Callable[[int], DataFrame]


@dataclass(frozen=True)
class Options:
    """How runs treat their tables."""

    gate: str = ALWAYS
    # Refuses a run that would flag more than this part of the active rows. It guards the gate ``always``
    # only, where an empty source would flag everything, and no dry run.
    max_delete_fraction: float | None = None
    null_safe_keys: bool = False
    null_flag_is_active: bool = False
    snapshot_source: bool = True
    dry_run: bool = False
    # Partitions are replaced by Spark's overwrite of their files, or, of tables that are read through the catalog
    # alone, by switching their locations, which a crash cannot leave half done.
    swap_locations: bool = False
    broadcast_limit: int = BROADCAST_LIMIT


@dataclass(frozen=True)
class Outcome:
    """What one run found and did. ``missing_keys`` are the staged keys of the update set; rows with a
    NULL in their key are in ``flagged_count`` only, unless keys are compared null-safely."""

    spec: TableSpec
    status: str
    source_count: int
    target_count: int
    flagged_count: int
    missing_keys: DataFrame | None
    audit: DataFrame


@dataclass(frozen=True)
class _UpdateSet:
    keys: Sized
    rows: DataFrame
    rows_by_partition: dict[str | None, int]
    # Of keys that are too many for a broadcast.
    likely: KeyFilter | None = None

    @property
    def size(self) -> int:
        return sum(self.rows_by_partition.values())


def reconcile(
    spark: SparkSession,
    spec: TableSpec,
    source: Source,
    path: str,
    database: str | None = None,
    audit_path: str | None = None,
    options: Options = Options(),
    run_time: str | None = None,
    run_id: str = "",
    folder: str | None = None,
    digests: str | None = None,
) -> Outcome:
    """Flag the rows of the table at ``path`` whose key is gone from ``source``, and audit the run.

    ``digests`` is a folder of this table's own where digests of key ranges are kept between runs, so that only ranges that
    have changed since the last one are compared. The keys of the source are read once, into the shared folder: the count, the gate and the comparison
    all see the same rows, also when executors are lost. A run that is repeated finds nothing more to flag.
    """
    spec.check()
    if options.gate not in GATES:
        raise ValueError(f"unknown gate {options.gate!r}, expected one of {GATES}")
    run_time = run_time or utc_now()
    # A given folder may serve many tables and runs, so each gets a new one below it.
    folder = f"{folder.rstrip('/')}/{spec.target_name}-{uuid4().hex}" if folder else work_folder(spark, spec.target_name)
    counts: list[int | None] = [None, None]

    def record(status: str) -> DataFrame:
        row = audit_record(counts_frame(spark, *counts), spec, run_time, run_id, status)
        if audit_path:
            append_audit(row, audit_path)
        return row

    try:
        if database:
            require_table(spark, database, spec.target_name)
        if options.swap_locations and not database:
            raise ValueError("locations are switched in the catalog, so a database must be given")
        if options.swap_locations:
            stored = read_registered(spark, registered_name(database, spec.target_name))
        else:
            stored = read_target(spark, path, partition_col=spec.partition_col)
        check_required(stored, [*spec.keys, spec.flag_col, spec.partition_col, spec.ordering])
        active = stored.filter(is_active(spec.flag_col, options.null_flag_is_active))
        ours = measured(active, spec.keys, options.null_safe_keys)
        counts[1] = ours.rows
        rows = source(counts[1]) if callable(source) else source
        source_keys = align_keys(rows, stored.schema, spec.keys)
        if options.snapshot_source:
            # The write counts the keys; only those that are too large for a broadcast are looked at again.
            source_keys, theirs = stage_keys(source_keys, spec.keys, f"{folder}/source_keys")
        else:
            theirs = measured(source_keys, spec.keys, options.null_safe_keys)
        counts[0] = theirs.rows

        kept = now = None
        if digests:
            kept = dg.read_digests(spark, digests)
            shift = kept.shift if kept else dg.width_of(source_keys, spec.keys)
            sides = [dg.key_digests(df, spec.keys, shift, options.null_safe_keys) for df in (source_keys, active)]
            now = stage(dg.both_sides(*sides), f"{folder}/digests")
        update = None
        if gate_is_open(counts[0] - counts[1], options.gate):
            way = BROADCAST
            if theirs.broadcast_bytes > options.broadcast_limit:
                way = way_of(ours, measured(source_keys, spec.keys, options.null_safe_keys) if options.snapshot_source else theirs)
            compared = (active, source_keys)
            if kept:
                changed = stage(dg.changed_ranges(now, kept.rows), f"{folder}/changed_ranges")
                compared = tuple(dg.in_ranges(df.select(*map(column, spec.keys)), changed, spec.keys, shift) for df in compared)
            update = _find_update_set(active, compared, way, spec, options, folder)
            if options.gate == ALWAYS and not options.dry_run:
                check_delete_fraction(update.size, counts[1], options.max_delete_fraction)
            update_rows = flag_deleted(drop_meta(stored, spec.meta_prefix), spec.flag_col)
            # The rows to write come from the files; where the table is registered, its own schema says what they must be.
            expected = spark.table(f"`{database}`.`{spec.target_name}`") if database else stored
            expected = drop_meta(expected, spec.meta_prefix)
            check_columns(expected, update_rows)
            check_schema(expected, update_rows)
            if now is not None and not options.dry_run:
                # What is active after this run; taken before the files of the flagged rows change.
                gone = dg.key_digests(update.rows, spec.keys, shift, options.null_safe_keys)
                theirs_now, ours_now = (now.filter(F.col("side") == side) for side in (dg.SOURCE, dg.TARGET))
                now = stage(dg.both_sides(theirs_now, dg.without(ours_now, gone)), f"{folder}/digests_after")
            if update.size and not options.dry_run:
                _flag_in_place(stored, update, spec, options, path, database)
                if database:
                    spark.catalog.refreshTable(f"`{database}`.`{spec.target_name}`")
            if now is not None and not options.dry_run:
                dg.write_digests(now, digests, shift, kept)
    except Exception as error:
        try:
            record(FAILED)
        except Exception as unrecorded:
            error.add_note(f"the failed run could not be recorded: {unrecorded}")
        raise

    flagged = update.size if update else 0
    idle = options.dry_run or (options.gate == ALWAYS and not flagged)
    status = SKIPPED if idle else COMPLETED
    log.info("%s: %s, %d rows flagged", spec.target_name, status, flagged)
    missing = update.keys.rows if update else None
    try:
        audit = record(status)
    except Exception as error:
        changed = "not changed" if options.dry_run or not flagged else f"changed: {flagged} rows are flagged"
        error.add_note(f"the run could not be recorded; table {spec.target_name} was {changed}")
        raise
    return Outcome(spec, status, counts[0], counts[1], flagged, missing, audit)


def _find_update_set(
    active: DataFrame,
    compared: tuple[DataFrame, DataFrame],
    way: str,
    spec: TableSpec,
    options: Options,
    folder: str,
) -> _UpdateSet:
    keys = list(spec.keys)
    null_safe = options.null_safe_keys
    missing = missing_keys(*compared, keys, null_safe, way=way)
    gone = stage_sized(missing, f"{folder}/missing_keys", options.broadcast_limit)
    narrow = active.select(*map(column, dict.fromkeys([*keys, spec.partition_col])))
    likely = None if gone.small else key_filter(gone.rows, active.schema, keys, f"{folder}/key_filter", options.broadcast_limit)
    rows = rows_with_keys(narrow, gone, keys, null_safe, likely)
    # One row per partition directory, which the driver lists anyway.
    per_partition = rows.groupBy(column(spec.partition_col)).agg(F.count(F.lit(1))).collect()
    return _UpdateSet(gone, rows, {partition: n for partition, n in per_partition}, likely)


def _flag_in_place(
    stored: DataFrame, update: _UpdateSet, spec: TableSpec, options: Options, path: str, database: str | None
) -> None:
    """Rewrite the partitions that hold rows of the update set, with these rows flagged."""
    touched = stored.filter(in_values(spec.partition_col, list(update.rows_by_partition)))
    rows = flag_rows(
        touched,
        update.keys,
        list(spec.keys),
        spec.flag_col,
        options.null_safe_keys,
        options.null_flag_is_active,
        update.likely,
        spec.partition_col,
    )
    check_written(rows, stored.schema)
    # With a filter, the rows that were shuffled have been gathered already.
    gather = not update.keys.small and update.likely is None
    if options.swap_locations:
        swap_partitions(rows, registered_name(database, spec.target_name), spec.partition_col, gather=gather)
    else:
        overwrite_partitions(rows, path, spec.partition_col, gather=gather)


class UnreconciledTables(ExceptionGroup):
    """The errors of the tables that failed; ``outcomes`` are those of the tables that did not."""

    outcomes: list[Outcome] = []


def reconcile_all(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    sources: Mapping[str, Source],
    paths: Mapping[str, str],
    parallel: int = 1,
    **settings,
) -> list[Outcome]:
    """One run per table, by its name, ``parallel`` of them at a time, those with the largest files first.

    Each run has a scheduler pool of its own. Where ``spark.scheduler.mode`` is FAIR, runs share the executors, and a small
    table is not held up by the tasks of a large one. A failed table does not stop the others; their errors are raised together at the end, with the outcomes of the others.
    """
    specs = list(specs)
    for spec in specs:
        spec.check()
        if spec.name not in sources or spec.name not in paths:
            raise ValueError(f"no source or no path is given for table {spec.name}")

    def run(spec: TableSpec) -> Outcome | Exception:
        try:
            return reconcile(spark, spec, sources[spec.name], paths[spec.name], **settings)
        except Exception as error:
            error.add_note(f"table {spec.name}")
            return error

    def pooled(spec: TableSpec) -> Outcome | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.target_name)
        return run(spec)

    # The order only matters if not all of them run at once.
    order = specs if parallel >= len(specs) else sorted(specs, key=lambda spec: -stored_bytes(spark, paths[spec.name]))
    with ThreadPoolExecutor(parallel) as pool:
        begun = {spec.name: pool.submit(inheritable_thread_target(spark)(pooled), spec) for spec in order}
        results = [begun[spec.name].result() for spec in specs]
    errors = [result for result in results if isinstance(result, Exception)]
    if errors:
        group = UnreconciledTables("some tables were not reconciled", errors)
        group.outcomes = [result for result in results if isinstance(result, Outcome)]
        raise group
    return results


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of the files at ``path``, from their listing alone."""
    try:
        plan = spark.read.schema("size int").parquet(path)._jdf.queryExecution().optimizedPlan()
        return int(str(plan.stats().sizeInBytes()))
    except AnalysisException:
        return 0


def summary(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    """One row per run: its table and its counts."""
    rows = [(o.spec.name, o.source_count, o.target_count, o.flagged_count) for o in outcomes]
    return spark.createDataFrame(
        rows, "table_name string, source_count bigint, target_count bigint, missing_count bigint"
    )
