"""Key joins in which NULL equals NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column

_OTHER = "__other_key_{}"
_HASH = "__key_hash"


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``df``, for the right side of a join with rows of which many may share a key.

    Copies of a key shrink within each task, before the shuffle. The keys are grouped together with their
    hash so that a later join shuffles them again, for itself: at run time Spark splits the skewed
    partitions of a join only if both sides come straight from a shuffle made for the join.
    """
    columns = [column(k) for k in keys]
    hashed = df.select(*columns, F.xxhash64(*columns).alias(_HASH))
    return hashed.distinct().select(*columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with ``<=>``; the result has the keys of ``left`` only."""
    names = {key: _OTHER.format(i) for i, key in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    matches = reduce(
        lambda a, b: a & b, [column(key).eqNullSafe(column(name)) for key, name in names.items()]
    )
    return left.join(right, matches, how).drop(*names.values())


def key_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    """Join on ``keys``, by ``<=>`` or by ``=``, in the column order of ``left``."""
    if null_safe:
        return null_safe_join(left, right, keys, how)
    joined = left.join(right, list(keys), how)
    return joined.select(
        *[column(c) for c in left.columns],
        *[column(c) for c in joined.columns if c not in set(left.columns)],
    )
