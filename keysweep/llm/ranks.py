"""Ranks of rows within groups of any size, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.staging import Stage, same

# Bits of a place that number the rows of a task; the task's own number is above them.
TASK_BITS = 33


def placed(stage: Stage, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows``, written, with a place that ascends by ``order``: ranges of rows are dealt to tasks, and sorted there.

    Samples of the columns of ``order`` reach the driver, so they must be short.
    """
    keys = [column(c) for c in order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(dealt.withColumn("place", F.monotonically_increasing_id()), name)


def with_ranks(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` with a place, and their rank from 0 in their group and the group's number of rows.

    A group's places in one task follow each other, so a rank is a place less a number that the group has in that task.
    There are no more such numbers than groups and tasks together.
    """
    rows = rows.withColumn("task", F.shiftright("place", TASK_BITS))
    runs = rows.groupBy(column(group), "task").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(column(group)).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        column(group).alias("run_group"),
        F.col("task").alias("run_task"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(column(group))).alias("total"),
    )
    met = rows.join(runs, same(column(group), F.col("run_group")) & (F.col("task") == F.col("run_task")))
    return met.withColumn("rank", F.col("place") + F.col("shift")).drop("task", "shift", "run_group", "run_task")
