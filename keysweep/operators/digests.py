"""Digests of the keys of a table by ranges, kept from one run to the next, to compare only what has changed since.

After a run every active key of the replica is in the source. A range of keys whose source keys and whose active keys are
both what they were then has nothing to flag now. Keys of a range count, and their hashes are added up and combined by
exclusive or, which needs no order and no shuffle of keys: each task sends one row for each range it has met. Ranges
have parents; only where a parent's digests differ, those of its ranges are looked at.

Whole numbers as first key are cut into ranges of equal width, so that new rows change the last ranges alone. Other keys
fall into ranges by a hash of the first key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column, none_null
from keysweep.sinks.files import child_folders, delete_folder

# Ranges that a table is cut into when its digests are first taken, and the most of them that are kept.
RANGES = 1 << 14
MOST_RANGES = 4 * RANGES
# Ranges of a parent: 2 ** PARENT_BITS.
PARENT_BITS = 7

SOURCE, TARGET = "source", "target"
FIGURES = ("rows", "sum", "xor")
SCHEMA = "generation bigint, shift int, total bigint, side string, range bigint, rows bigint, sum bigint, xor bigint"
# Bits of hashes that are added up; the sum of two billion rows of a range fits a number.
SUMMED_BITS = 0xFFFFFFFF
_RANGE = "__range"


@dataclass(frozen=True)
class Kept:
    """Digests of an earlier run, and how keys fall into their ranges. ``shift`` is None for hashed keys."""

    rows: DataFrame
    shift: int | None
    generation: int


def width_of(df: DataFrame, keys: Sequence[str]) -> int | None:
    """By how many bits the first key is shifted for its range, or None if it is hashed."""
    if not isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        return None
    low, high = df.agg(F.min(column(keys[0])), F.max(column(keys[0]))).first()
    return 0 if low is None else max(0, ((high - low) // RANGES).bit_length())


def range_of(keys: Sequence[str], shift: int | None) -> Column:
    if shift is None:
        return F.pmod(F.xxhash64(column(keys[0])), F.lit(RANGES)).cast("bigint")
    return F.shiftright(column(keys[0]).cast("bigint"), shift)


def key_digests(df: DataFrame, keys: Sequence[str], shift: int | None, null_safe: bool = False) -> DataFrame:
    """range, rows, sum and xor of the keys of ``df``; keys with a NULL part count only if they can match."""
    rows = df if null_safe else df.filter(none_null(keys))
    hashed = rows.select(range_of(keys, shift).alias("range"), F.xxhash64(*map(column, keys)).alias("hash"))
    return hashed.groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("hash").bitwiseAND(SUMMED_BITS)).alias("sum"), F.bit_xor("hash").alias("xor")
    )


def both_sides(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select(F.lit(SOURCE).alias("side"), "range", *FIGURES).unionByName(target.select(F.lit(TARGET).alias("side"), "range", *FIGURES))


def without(digests: DataFrame, gone: DataFrame) -> DataFrame:
    """The digests of the active keys when rows with the digests ``gone`` are active no more."""
    parts = digests.select("range", *FIGURES).unionByName(gone.select("range", (-F.col("rows")).alias("rows"), (-F.col("sum")).alias("sum"), "xor"))
    return summed(parts, ["range"]).filter("rows > 0")


def summed(digests: DataFrame, by: Sequence[str]) -> DataFrame:
    return digests.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum"), F.bit_xor("xor").alias("xor"))


def _differing(now: DataFrame, before: DataFrame, by: str) -> DataFrame:
    """Values of ``by`` where a side's digests are not the same, or only one has any."""
    parts = now.select("side", by, *FIGURES, F.lit(1).alias("which")).unionByName(before.select("side", by, *FIGURES, F.lit(2).alias("which")))
    sides = parts.groupBy("side", by, *FIGURES).agg(F.sum("which").alias("which"))
    return sides.filter("which <> 3").select(by).distinct()


def changed_ranges(now: DataFrame, before: DataFrame) -> DataFrame:
    """Ranges whose digests changed on either side. Ranges are compared below parents that differ, and nowhere else."""
    parent = F.shiftright("range", PARENT_BITS)
    now, before = (d.select("side", parent.alias("parent"), "range", *FIGURES) for d in (now, before))
    parents = _differing(*(summed(d, ["side", "parent"]) for d in (now, before)), by="parent")
    return _differing(*(d.join(F.broadcast(parents), "parent", "left_semi") for d in (now, before)), by="range")


def in_ranges(df: DataFrame, changed: DataFrame, keys: Sequence[str], shift: int | None) -> DataFrame:
    """Rows of ``df`` whose key is in a changed range. At most ``MOST_RANGES`` are broadcast; rows stay where they are."""
    ranges = F.broadcast(changed.select(F.col("range").alias(_RANGE)))
    marked = df.withColumn(f"{_RANGE}_of_key", range_of(keys, shift))
    return marked.join(ranges, F.col(f"{_RANGE}_of_key").eqNullSafe(F.col(_RANGE)), "left_semi").drop(f"{_RANGE}_of_key")


def read_digests(spark: SparkSession, path: str) -> Kept | None:
    """The digests of the last run that has written all of its own; None if there are none that are whole."""
    for folder in reversed(child_folders(spark, path)):
        rows = spark.read.schema(SCHEMA).parquet(folder)
        found = rows.agg(F.count(F.lit(1)), F.max("total"), F.max("shift"), F.max("generation")).first()
        if found[0] and found[0] == found[1] and found[0] <= 2 * MOST_RANGES:
            return Kept(rows.select("side", "range", *FIGURES), found[2], found[3])
    return None


def write_digests(digests: DataFrame, path: str, shift: int | None, last: Kept | None) -> None:
    """Keep ``digests``, staged, in a new folder of ``path``; older ones go once it is written.

    A table with too many ranges, which grew far beyond its first width, keeps none, and is cut anew by its next run.
    """
    spark = digests.sparkSession
    generation = last.generation + 1 if last else 0
    older = child_folders(spark, path)
    total = digests.count()
    if total > 2 * MOST_RANGES:
        for name in older:
            delete_folder(spark, name)
        return
    figures = [F.lit(generation).cast("bigint").alias("generation"), F.lit(shift).cast("int").alias("shift"), F.lit(total).cast("bigint").alias("total")]
    place = f"{path.rstrip('/')}/{generation:019d}-{uuid4().hex}"
    digests.select(*figures, "side", "range", *FIGURES).write.parquet(place)
    for name in older:
        delete_folder(spark, name)
