"""Intermediate tables in the shared folder of the cluster, and the size check before a broadcast.

A staged table cuts the lineage of what follows, gives every later job the same rows, and outlives
the executors that wrote it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column

# Largest key set, in estimated bytes in memory, that is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024
# In-memory cost of one row and of one field of a broadcast hash table, besides its text.
ROW_OVERHEAD = 48
FIELD_OVERHEAD = 16
FIXED_SIZE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def work_folder(spark: SparkSession, purpose: str = "run") -> str:
    """A new folder under ``spark.checkpoint.dir``; local sessions without one get a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="keysweep-")
    return f"{shared.rstrip('/')}/keysweep/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once, to a folder that does not exist yet, and return the written rows."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, path: str, **figures: Column) -> tuple[DataFrame, dict[str, object]]:
    """``stage``, and aggregates of ``df`` that its tasks take on the way.

    The write follows without a shuffle, so that each of its tasks counts once, also if it had to be repeated.
    """
    seen = Observation()
    rows = stage(df.observe(seen, *[value.alias(name) for name, value in figures.items()]), path)
    return rows, seen.get


def row_bytes(df: DataFrame, names: Sequence[str]) -> Column:
    """Estimated size of a row of ``names`` in a broadcast hash table, on the safe side."""
    fixed = F.lit(ROW_OVERHEAD + FIELD_OVERHEAD * len(names)).cast("bigint")
    lengths = [
        F.coalesce(F.octet_length(column(field.name).cast("string")), F.lit(0))
        for field in df.select(*map(column, names)).schema
        if not isinstance(field.dataType, FIXED_SIZE)
    ]
    return sum(lengths, fixed)


def broadcast_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(row_bytes(df, df.columns))).first()[0] or 0


@dataclass(frozen=True)
class Sized:
    """A staged table that was measured to fit a broadcast, or not to."""

    rows: DataFrame
    small: bool

    @property
    def hint(self) -> str:
        """How to join with it. A sort-merge join is the one whose skew Spark splits at run time."""
        return "broadcast" if self.small else "merge"

    @property
    def hinted(self) -> DataFrame:
        return self.rows.hint(self.hint)


def sized(staged: DataFrame, limit: int = BROADCAST_LIMIT) -> Sized:
    return Sized(staged, broadcast_bytes(staged) <= limit)


def stage_sized(df: DataFrame, path: str, limit: int = BROADCAST_LIMIT) -> Sized:
    return sized(stage(df, path), limit)
