"""The latest row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column

_RANK = "__rank"


def ordering_value(name: str, ordering_type: str | None = None) -> Column:
    """The ordering column in the type it is compared in."""
    return column(name).cast(ordering_type) if ordering_type else column(name)


def latest_wins(
    df: DataFrame,
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ordering value; a NULL value is the smallest.

    Ties are broken by the greatest value of the ``tie_break`` columns in turn, by default all other
    columns, so the result does not depend on how the rows are distributed; maps compare by their sorted entries. Spark drops all but the
    first row of a key within each task before the shuffle, so a frequent key does not pile up.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, ordering}]
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)}
    ties = [F.array_sort(F.map_entries(column(c))) if c in maps else column(c) for c in tie_break]
    order = [ordering_value(ordering, ordering_type), *ties]
    window = Window.partitionBy(*map(column, keys)).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
