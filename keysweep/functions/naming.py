"""Names derived from a table's system, its own name and the environment."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text format of run times.
RUN_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def target_name(system: Column, table: Column) -> Column:
    return F.concat_ws("_", system, table)


def database_name(environment: Column, suffix: str) -> Column:
    return F.concat(environment, F.lit(suffix))


def target_path(template: str, **parts: Column) -> Column:
    """``template`` with each ``{name}`` replaced by the column given for it."""
    path = F.lit(template)
    for name, value in parts.items():
        path = F.replace(path, F.lit("{" + name + "}"), value)
    return path


def utc_text(instant: Column) -> Column:
    """An instant as text in UTC, whatever the time zone of the session."""
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), RUN_TIME_PATTERN)


def audit_key(table: Column, run_time: Column) -> Column:
    return F.concat(table, run_time)


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
