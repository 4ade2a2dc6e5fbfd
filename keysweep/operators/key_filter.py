"""A broadcast table of bits that tells most rows whose key is not in a large set of keys, so that they skip its join.

Each key of the set sets one bit, by its hash. A row whose bit is not set has no partner and stays where it is; a row whose bit
is set may have one, which the join decides. The bits take two bytes for each key up to a limit. Beyond it they fill up, and more rows go
through the join, so a table of any size stays within the limit. They travel in blocks of words, as a row for each word would take ten times their room.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.operators.bitmaps import WORD_BITS, bit_of, word_of
from keysweep.storage import BROADCAST_LIMIT, FIELD_OVERHEAD, ROW_OVERHEAD, stage

BITS_PER_KEY = 16
# Words of a block, as a power of two, where the limit has room for one.
BLOCK_BITS = 6
# In-memory cost of a block of one word and its number, and of each further word.
WORD_BYTES = ROW_OVERHEAD + 2 * FIELD_OVERHEAD
MORE_BYTES = 8

_BLOCK = "__key_block"
_WORD = "__key_word"
_MASK = "__key_mask"
_MASKS = "__key_masks"
MAY_HOLD = "__may_hold"


def can_be_filtered(schema: T.StructType, keys: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes: not so texts that a collation makes equal."""
    plain = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)
    return all(isinstance(schema[key].dataType, plain) or schema[key].dataType == T.StringType() for key in keys)


def _place(schema: T.StructType, keys: Sequence[str], bits: int) -> Column:
    """The bit of a key. Zeros of both signs are one key."""
    floats = (T.FloatType, T.DoubleType)
    values = [column(k) + F.lit(0.0).cast(schema[k].dataType) if isinstance(schema[k].dataType, floats) else column(k) for k in keys]
    return F.pmod(F.xxhash64(*values), F.lit(bits))


@dataclass(frozen=True)
class KeyFilter:
    """Blocks of bits (number, masks of 2 ** ``block_bits`` words) of a set of keys, ``bits`` in all, by the hashes of ``keys`` in the types of ``schema``."""

    words: DataFrame
    bits: int
    keys: tuple[str, ...]
    schema: T.StructType
    block_bits: int = BLOCK_BITS

    def mark(self, df: DataFrame) -> DataFrame:
        """``df`` with, in ``MAY_HOLD``, whether the key of a row may be in the set."""
        place = _place(self.schema, self.keys, self.bits)
        block, word = _block_and_word(place, self.block_bits)
        joined = df.withColumn(_BLOCK, block).join(self.words.hint("broadcast"), _BLOCK, "left")
        held = F.coalesce(F.get(_MASKS, word).bitwiseAND(bit_of(place)) != 0, F.lit(False))
        return joined.select(*map(column, df.columns), held.alias(MAY_HOLD))


def _block_and_word(place: Column, block_bits: int) -> tuple[Column, Column]:
    """The block of a bit, and the word in it."""
    word = word_of(place)
    return F.shiftright(word, block_bits), word.bitwiseAND(F.lit((1 << block_bits) - 1)).cast("int")


def block_bytes(block_bits: int) -> int:
    return WORD_BYTES + MORE_BYTES * ((1 << block_bits) - 1)


def key_filter(
    gone: DataFrame, schema: T.StructType, keys: Sequence[str], path: str, limit: int = BROADCAST_LIMIT
) -> KeyFilter | None:
    """The filter of the staged keys ``gone`` for rows of ``schema``, staged at ``path``; None if there is no room or no use for one."""
    if not can_be_filtered(schema, keys) or limit < WORD_BYTES:
        return None
    count = gone.count()
    block_bits = BLOCK_BITS if limit >= block_bytes(BLOCK_BITS) else 0
    size = WORD_BITS + block_bits
    bits = min(limit // block_bytes(block_bits), -(-count * BITS_PER_KEY >> size) or 1) << size
    own = gone.select(*[column(key).cast(schema[key].dataType).alias(key) for key in keys])
    place = _place(schema, keys, bits)
    block, word = _block_and_word(place, block_bits)
    placed = own.select(block.alias(_BLOCK), word.alias(_WORD), bit_of(place).alias(_MASK))
    words = placed.groupBy(_BLOCK, _WORD).agg(F.bit_or(_MASK).alias(_MASK))
    by_word = words.groupBy(_BLOCK).agg(F.map_from_entries(F.collect_list(F.struct(_WORD, _MASK))).alias(_MASKS))
    every = F.sequence(F.lit(0), F.lit((1 << block_bits) - 1))
    masks = F.transform(every, lambda at: F.coalesce(F.element_at(_MASKS, at), F.lit(0).cast("bigint")))
    return KeyFilter(stage(by_word.select(_BLOCK, masks.alias(_MASKS)), path), bits, tuple(keys), schema, block_bits)
