"""Soft-delete reconciliation of a replica table with its source, on Spark."""

from keysweep.functions.columns import drop_meta, null_fill, stringify
from keysweep.operators.counts import run_counts
from keysweep.operators.latest import latest_wins
from keysweep.operators.missing import (
    find_missing,
    flag_deleted,
    flag_rows,
    left_join_flagged,
    missing_in_source,
    missing_keys,
)
from keysweep.operators.upsert import upsert
from keysweep.operators.validate import check_columns, check_schema
from keysweep.plans.reconcile import Options, Outcome, reconcile, reconcile_all, summary
from keysweep.sinks.audit import append_audit, audit_record, compact_audit, read_audit
from keysweep.sinks.publish import (
    overwrite_partitions,
    publish_table,
    upsert_to_path,
    upsert_to_table,
    write_partitioned,
)
from keysweep.sinks.swap import read_registered, remove_unused, swap_partitions
from keysweep.sources.config import read_table_config, table_specs
from keysweep.sources.jdbc import jdbc_source, password_profile, read_source_keys, token_profile
from keysweep.sources.target import read_csv_snapshot, read_target, read_target_active, table_exists
from keysweep.spec import TableSpec

__all__ = [name for name in dir() if not name.startswith("_")]
