"""Row counts of a run, and the gate they decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALWAYS = "always"
SOURCE_EXCEEDS_TARGET = "source_exceeds_target"
GATES = (ALWAYS, SOURCE_EXCEEDS_TARGET)


def run_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows of the source, active rows of the target, and the signed difference."""
    counted = F.count(F.lit(1))
    none = F.lit(0).cast("bigint")
    parts = source.agg(counted.alias("source_count")).withColumn("target_count", none).unionByName(
        target.agg(counted.alias("target_count")).withColumn("source_count", none)
    )
    return parts.agg(
        F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count")
    ).withColumn("count_diff", F.col("source_count") - F.col("target_count"))


def gate_is_open(count_diff: int, gate: str = ALWAYS) -> bool:
    """Whether a run with this difference may change the target."""
    if gate not in GATES:
        raise ValueError(f"unknown gate {gate!r}, expected one of {GATES}")
    return gate == ALWAYS or count_diff > 0


def check_delete_fraction(flagged: int, active: int, limit: float | None) -> None:
    """Refuse to flag more than ``limit`` of the active rows, as after a failed, empty source read. None: no limit."""
    if limit is not None and flagged > limit * active:
        raise ValueError(
            f"{flagged} of {active} active rows would be flagged as deleted, "
            f"more than the allowed fraction {limit}"
        )
