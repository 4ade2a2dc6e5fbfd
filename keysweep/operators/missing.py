"""Which target rows have a key that the source no longer holds.

Two ways give the same rows, and ``find_missing`` chooses by measured sizes:

* ``missing_in_source`` anti-joins whole target rows. It is one lazy plan, and shuffles every column of
  the target unless the source keys are small.
* ``missing_keys`` compares keys alone and returns the distinct missing ones; ``rows_with_keys`` and
  ``flag_rows`` then find their rows. Only key columns are shuffled.

With ``=`` keys, a target row with a NULL in any key part matches nothing and is always missing. Such
rows never need a partner, so they skip the joins and cannot pile up in one shuffle partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import any_null, column, is_active, none_null, quoted
from keysweep.operators.bitmaps import can_be_bits, key_density, missing_integers
from keysweep.operators.joins import distinct_keys, key_join
from keysweep.operators.key_filter import MAY_HOLD, KeyFilter, key_filter
from keysweep.spec import DELETED, FLAG_COLUMN
from keysweep.storage import BROADCAST_LIMIT, Sized, row_bytes, stage, stage_observed, stage_sized

# Keys are counted in this many buckets. A table is even if its fullest bucket, and so any key, holds few
# enough rows for one task, however large the table is.
BUCKETS = 1 << 16
EVEN_ROWS = 1_000_000

# Ways to compare the keys of both sides: the source is broadcast; integers become bits; a join; an aggregate.
BROADCAST, BITMAP, JOIN, AGGREGATE = "broadcast", "bitmap", "join", "aggregate"

_IN_SOURCE = "__in_source"
_MATCHED = "__matched"


def left_join_flagged(
    target: DataFrame, source: DataFrame, keys: Sequence[str], flag_col: str = FLAG_COLUMN
) -> DataFrame:
    """Every target row once, with its flag and, in ``<flag>_new``, the flag it should have.

    The keys come first. Copies of a source key match like one.
    """
    new_flag = f"{flag_col}_new"
    left = target.filter(none_null(keys)).alias("target")
    joined = left.join(distinct_keys(source, keys).alias("source"), list(keys), "left")
    unmatched = F.col(f"source.{quoted(keys[0])}").isNull()
    old_flag = F.col(f"target.{quoted(flag_col)}")
    with_key = joined.withColumn(new_flag, F.when(unmatched, F.lit(DELETED)).otherwise(old_flag))
    return with_key.unionByName(
        target.filter(any_null(keys)).withColumn(new_flag, F.lit(DELETED))
    )


def missing_in_source(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``, by an anti join of whole rows."""
    if null_safe:
        return key_join(target, distinct_keys(source, keys), keys, "left_anti", null_safe)
    with_key = target.filter(none_null(keys))
    unmatched = key_join(with_key, distinct_keys(source, keys), keys, "left_anti", null_safe)
    return unmatched.unionByName(target.filter(any_null(keys)))


@dataclass(frozen=True)
class Spread:
    """How the rows of a table spread over its keys."""

    rows: int
    largest_bucket: int
    broadcast_bytes: int

    @property
    def even(self) -> bool:
        """Whether no key can hold many more rows than others: no key exceeds its bucket."""
        return self.largest_bucket <= EVEN_ROWS


def key_spread(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Spread:
    """The rows of ``df``, in all and in the fullest of a fixed number of hash buckets of its keys, and the
    size of its keys as a broadcast table.

    Keys with a NULL part are in no bucket unless they can match. Each task counts by itself; only the
    bucket counts are shuffled.
    """
    bucket = F.pmod(F.xxhash64(*map(column, keys)), F.lit(BUCKETS))
    bucket = bucket if null_safe else F.when(none_null(keys), bucket)
    per_bucket = df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df, keys)).alias("bytes")
    )
    in_bucket = F.when(F.col("bucket").isNotNull(), F.col("n"))
    figures = per_bucket.agg(F.sum("n"), F.max(in_bucket), F.sum("bytes")).first()
    return Spread(*[figure or 0 for figure in figures])


@dataclass(frozen=True)
class Measured:
    """The rows of a table, the size of its keys as a broadcast table, and the ways to compare keys that suit them."""

    rows: int
    broadcast_bytes: int
    dense: bool
    even: bool


def measured(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Measured:
    """Whether the keys of ``df`` are integers that lie close together in each task, or else spread evenly, in a scan for each."""
    if can_be_bits(df.schema, keys) and not null_safe:
        density = key_density(df, keys[0])
        if density.dense:
            return Measured(density.rows, density.broadcast_bytes, True, False)
    spread = key_spread(df, keys, null_safe)
    return Measured(spread.rows, spread.broadcast_bytes, False, spread.even)


def way_of(target: Measured, source: Measured) -> str:
    """How to compare the keys of a source that is too large for a broadcast."""
    if target.dense and source.dense:
        return BITMAP
    return JOIN if target.even and source.even else AGGREGATE


def missing_keys(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    even: bool = False,
    way: str | None = None,
) -> DataFrame:
    """Distinct keys of ``target`` that are not in ``source``.

    With ``=`` keys, those with a NULL part are left out: all of them are missing, see ``any_null``.
    The comparison is an aggregate, so copies of one key shrink to one row per task before the shuffle, on
    both sides. If ``key_spread`` has shown both sides to be ``even``, there is nothing to shrink, and an
    anti join of the keys takes less work. ``way`` names these and the other ways, see ``way_of``.
    """
    way = way or (JOIN if even else AGGREGATE)
    columns = [column(k) for k in keys]
    theirs, ours = source.select(*columns), target.select(*columns)
    if not null_safe:
        theirs, ours = theirs.filter(none_null(keys)), ours.filter(none_null(keys))
    if way == BITMAP:
        return missing_integers(ours, theirs, keys[0])
    if way == BROADCAST:
        return key_join(ours, theirs.hint("broadcast"), keys, "left_anti", null_safe).distinct()
    if way == JOIN:
        return key_join(ours, theirs, keys, "left_anti", null_safe).distinct()
    both = ours.withColumn(_IN_SOURCE, F.lit(False)).unionByName(
        theirs.withColumn(_IN_SOURCE, F.lit(True))
    )
    found = both.groupBy(*columns).agg(F.max(_IN_SOURCE).alias(_IN_SOURCE))
    return found.filter(~F.col(_IN_SOURCE)).select(*columns)


def stage_keys(source: DataFrame, keys: Sequence[str], path: str) -> tuple[DataFrame, Measured]:
    """The keys of ``source``, written once, with their number and size, which the write has counted."""
    rows = source.select(*map(column, keys))
    bytes_ = F.sum(row_bytes(rows, keys))
    staged, seen = stage_observed(rows, path, rows=F.count(F.lit(1)), bytes=bytes_)
    return staged, Measured(seen["rows"] or 0, seen["bytes"] or 0, False, False)


def _marked(df: DataFrame, gone: Sized, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """``df`` with a mark on the rows whose key is in ``gone``."""
    marks = gone.hinted.withColumn(_MATCHED, F.lit(True))
    return key_join(df, marks, keys, "left", null_safe)


def rows_with_keys(
    df: DataFrame, gone: Sized, keys: Sequence[str], null_safe: bool = False, likely: KeyFilter | None = None
) -> DataFrame:
    """Rows of ``df`` whose key is in ``gone``, the distinct missing keys, or holds a NULL (``=`` keys).

    Where ``gone`` is broadcast, ``df`` is scanned once and stays where it is. Else only rows without a
    NULL in their key are shuffled, and with ``likely``, the filter of ``gone``, only those that it lets through.
    """
    if likely and not gone.small:
        possible = likely.mark(df if null_safe else df.filter(none_null(keys))).filter(MAY_HOLD).drop(MAY_HOLD)
        found = key_join(possible, gone.hinted, keys, "left_semi", null_safe)
        return found if null_safe else found.unionByName(df.filter(any_null(keys)))
    if null_safe:
        return key_join(df, gone.hinted, keys, "left_semi", null_safe)
    if gone.small:
        marked = _marked(df, gone, keys, null_safe)
        return marked.filter(column(_MATCHED).isNotNull() | any_null(keys)).drop(_MATCHED)
    with_key = key_join(df.filter(none_null(keys)), gone.hinted, keys, "left_semi", null_safe)
    return with_key.unionByName(df.filter(any_null(keys)))


def find_missing(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    folder: str,
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    even: bool | None = None,
    target_is_stored: bool = True,
) -> DataFrame:
    """The rows of ``missing_in_source``, in the way that suits the sizes of both sides.

    The source keys are staged in ``folder``, so that the source is read once, and counted on the way. If
    they fit they are broadcast, and the target is read once. Else the missing keys are found and
    staged before their rows are read; a target that is not a stored table is staged first.
    All this is measured, unless ``even`` says that the keys are to be compared, and how.
    """
    way = None
    if even is None:
        source, seen = stage_keys(source, keys, f"{folder}/source_keys")
        if seen.broadcast_bytes <= broadcast_limit:
            return _missing_in_small(target, source, keys, null_safe)
    if not target_is_stored:
        target = stage(target, f"{folder}/target")
    if even is None:
        way = way_of(measured(target, keys, null_safe), measured(source, keys, null_safe))
    gone = missing_keys(target, source, keys, null_safe, bool(even), way)
    staged = stage_sized(gone, f"{folder}/missing_keys", broadcast_limit)
    likely = None if staged.small else key_filter(staged.rows, target.schema, keys, f"{folder}/key_filter", broadcast_limit)
    return rows_with_keys(target, staged, keys, null_safe, likely)


def _missing_in_small(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool
) -> DataFrame:
    """The rows of ``missing_in_source`` for a source that was measured to fit a broadcast."""
    source_keys = source.select(*map(column, keys)).hint("broadcast")
    return key_join(target, source_keys, keys, "left_anti", null_safe)


def flag_deleted(rows: DataFrame, flag_col: str = FLAG_COLUMN) -> DataFrame:
    """``rows`` with the flag of a deleted row, in place."""
    return rows.withColumn(flag_col, F.lit(DELETED))


def flag_rows(
    stored: DataFrame,
    gone: Sized,
    keys: Sequence[str],
    flag_col: str = FLAG_COLUMN,
    null_safe: bool = False,
    null_is_active: bool = False,
    likely: KeyFilter | None = None,
    gather_by: str | None = None,
) -> DataFrame:
    """All of ``stored``, with the active rows of the distinct keys ``gone`` flagged.

    This is what an upsert of the update set comes to, since every incoming row ties with the stored
    row it was made from. It needs only the keys of the update set, not its rows. With ``likely``, the filter of ``gone``,
    only active rows that it lets through are joined, and brought together by ``gather_by`` as the join has scattered them; the others
    stay where they are.
    """
    active = is_active(flag_col, null_is_active)
    matched = column(_MATCHED).isNotNull()

    def flagged(df: DataFrame, condition: Column) -> DataFrame:
        new_flag = F.when(active & condition, F.lit(DELETED)).otherwise(column(flag_col))
        return df.withColumn(flag_col, new_flag).select(*map(column, stored.columns))

    if likely and not gone.small:
        may_match = F.coalesce(active & F.col(MAY_HOLD), F.lit(False))
        may_match = may_match if null_safe else may_match & none_null(keys)
        seen = likely.mark(stored)
        joined = flagged(_marked(seen.filter(may_match).drop(MAY_HOLD), gone, keys, null_safe), matched)
        if gather_by:
            joined = joined.hint("rebalance", column(gather_by))
        return joined.unionByName(flagged(seen.filter(~may_match), F.lit(False) if null_safe else any_null(keys)))
    if null_safe:
        return flagged(_marked(stored, gone, keys, null_safe), matched)
    if gone.small:
        return flagged(_marked(stored, gone, keys, null_safe), matched | any_null(keys))
    with_key = flagged(_marked(stored.filter(none_null(keys)), gone, keys, null_safe), matched)
    return with_key.unionByName(flagged(stored.filter(any_null(keys)), F.lit(True)))
