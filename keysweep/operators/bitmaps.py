"""Integer keys compared as bitmaps: 64 neighbouring keys are one row with a mask for each side.

Masks are built within each task, before the shuffle, and united by ``bit_or``. So copies of a key are one bit,
however many there are, and of a dense run of keys a sixty-fourth of the rows is shuffled. What is missing are the bits of
one mask that the other lacks; that needs whole numbers, which is why masks are numbers and not the binary bitmaps of
``bitmap_construct_agg``, which no built-in function subtracts.

Whether this pays is measured: a mask takes more room than a key, so the keys of a task must share words. They do where
a file holds a range of keys, as files of growing tables do, and do not where it holds scattered ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.storage import row_bytes

WORD_BITS = 6
# Keys of a task that share a word, on average, from which on masks take less room in a shuffle than keys.
DENSE = 4


def can_be_bits(schema: T.StructType, keys: Sequence[str]) -> bool:
    """Whether keys are single integers."""
    return len(keys) == 1 and isinstance(schema[keys[0]].dataType, T.IntegralType)


def word_of(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), WORD_BITS)


def bit_of(key: Column) -> Column:
    place = key.cast("bigint").bitwiseAND((1 << WORD_BITS) - 1).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


@dataclass(frozen=True)
class Density:
    """How keys lie in the tasks that read them. ``words`` are the masks that the tasks would send."""

    rows: int
    broadcast_bytes: int
    words: int

    @property
    def dense(self) -> bool:
        return self.rows > 0 and self.rows >= DENSE * self.words


def key_density(df: DataFrame, key: str) -> Density:
    """The rows of ``df``, the size of its keys as a broadcast table, and the words of keys in each of its tasks, in all.

    One row of each task is shuffled. Words are estimated to some percent.
    """
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(row_bytes(df, [key])).alias("bytes"),
        F.approx_count_distinct(word_of(column(key))).alias("words"),
    )
    return Density(*[x or 0 for x in per_task.agg(F.sum("n"), F.sum("bytes"), F.sum("words")).first()])


def missing_integers(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``target`` that are not in ``source``, without NULL."""
    kind = target.schema[key].dataType

    def masks(df: DataFrame, ours: bool) -> DataFrame:
        bit, none = bit_of(column(key)), F.lit(0).cast("bigint")
        sides = (bit, none) if ours else (none, bit)
        return df.filter(column(key).isNotNull()).select(word_of(column(key)).alias("word"), *[s.alias(n) for s, n in zip(sides, ("ours", "theirs"))])

    words = masks(target, True).unionByName(masks(source, False)).groupBy("word").agg(F.bit_or("ours").alias("ours"), F.bit_or("theirs").alias("theirs"))
    gone = words.select("word", F.col("ours").bitwiseAND(F.bitwise_not("theirs")).alias("gone")).filter("gone <> 0")
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)), lambda place: F.bit_get("gone", place) == 1)
    found = gone.select("word", F.explode(places).alias("place"))
    return found.select((F.shiftleft("word", WORD_BITS) + F.col("place")).cast(kind).alias(key))
