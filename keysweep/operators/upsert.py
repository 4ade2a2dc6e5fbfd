"""Ordered upsert: an incoming row replaces the stored row of its key unless the stored one is later.

Keys are compared with NULL equal to NULL, as record keys are. Two forms give the same rows:

* ``upsert`` ranks stored and incoming rows of a key together, in one lazy plan.
* ``stored_homes``, ``at_home`` and ``merge`` are the steps for a stored table, see ``upsert_to_path``:
  incoming rows are joined to the stored ones, and when they are few they are broadcast, so that no
  stored row is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keysweep.functions.columns import column, null_fill
from keysweep.operators.joins import null_safe_join
from keysweep.operators.latest import latest_wins, ordering_value

HOME = "__home"
COPIES = "__copies"
_INCOMING = "__incoming"
_RANK = "__rank"
_WRITTEN = "__written"


def stored_homes(
    stored: DataFrame, keys: Sequence[str], partition_col: str | None = None
) -> DataFrame:
    """Per stored key: how many rows hold it, and the partition they lie in."""
    home = column(partition_col) if partition_col else F.lit(None).cast("string")
    return stored.groupBy(*map(column, keys)).agg(
        F.count(F.lit(1)).alias(COPIES), F.max(home).alias(HOME)
    )


def at_home(
    incoming: DataFrame, homes: DataFrame, keys: Sequence[str], partition_col: str | None = None
) -> DataFrame:
    """Incoming rows with their count of stored rows, moved to the partition of the stored row."""
    found = null_safe_join(incoming, homes, keys, "left")
    columns = [column(c) for c in incoming.columns if c != partition_col]
    if partition_col:
        own = F.when(column(COPIES).isNotNull(), column(HOME)).otherwise(column(partition_col))
        columns.append(own.alias(partition_col))
    return found.select(*columns, column(COPIES))


def merge(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None = None,
    hint: str | None = None,
) -> DataFrame:
    """All rows after the upsert of ``incoming``, rows of distinct keys as ``at_home`` returns them."""
    names = stored.columns
    payload = incoming.filter(column(COPIES).isNotNull()).select(
        *map(column, keys), F.struct(*map(column, names)).alias(_INCOMING)
    )
    joined = null_safe_join(stored, payload.hint(hint) if hint else payload, keys, "left")
    replaced = column(_INCOMING).isNotNull() & ~_stored_is_later(ordering, ordering_type)
    updated = joined.select(
        *[F.when(replaced, F.col(_INCOMING)[c]).otherwise(column(c)).alias(c) for c in names]
    )
    inserted = incoming.filter(column(COPIES).isNull()).select(*map(column, names))
    return updated.unionByName(inserted)


def _stored_is_later(ordering: str, ordering_type: str | None) -> Column:
    ours = ordering_value(ordering, ordering_type)
    theirs = F.col(_INCOMING)[ordering]
    theirs = theirs.cast(ordering_type) if ordering_type else theirs
    return F.coalesce(ours > theirs, ours.isNotNull() & theirs.isNull())


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """All rows after upserting ``incoming`` into ``stored``, as one lazy plan with one shuffle of each.

    Of several incoming rows of a key the latest counts; columns the batch lacks become NULL; a row keeps
    the partition it is stored in. The query fails if a stored key that is written to is not unique.
    For a stored table, ``upsert_to_path`` avoids the shuffle of the stored rows.
    """
    names = stored.columns
    latest = latest_wins(null_fill(incoming, stored.schema), keys, ordering, ordering_type)
    rows = stored.withColumn(_INCOMING, F.lit(0)).unionByName(latest.withColumn(_INCOMING, F.lit(1)))

    key = Window.partitionBy(*map(column, keys))
    later_first = [ordering_value(ordering, ordering_type), column(_INCOMING)]
    ranked = key.orderBy(*[c.desc_nulls_last() for c in later_first])
    is_stored = column(_INCOMING) == 0
    rows = rows.withColumn(_RANK, F.row_number().over(ranked))
    rows = rows.withColumn(_WRITTEN, F.sum(_INCOMING).over(key))
    rows = rows.withColumn(COPIES, F.sum(F.lit(1) - column(_INCOMING)).over(key))

    message = F.lit(f"the stored rows are not unique by {','.join(keys)}")
    kept = (
        F.when(column(_WRITTEN) == 0, F.lit(True))
        .when(column(COPIES) > 1, F.raise_error(message).cast("boolean"))
        .otherwise(column(_RANK) == 1)
    )
    if partition_col:
        rows = rows.withColumn(HOME, F.max(F.when(is_stored, column(partition_col))).over(key))
        moved = ~is_stored & (column(COPIES) > 0)
        home = F.when(moved, column(HOME)).otherwise(column(partition_col))
        rows = rows.withColumn(partition_col, home)
    return rows.filter(kept).select(*map(column, names))
