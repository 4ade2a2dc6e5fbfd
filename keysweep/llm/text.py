"""Texts of Arrow batches as flat byte arrays: word spans, hashes of words and of word windows.

Everything here works on one bounded piece of a batch at a time (``PIECE_BYTES`` of text, or one longer document),
with vectorised numpy on the UTF-8 bytes. All separators in use are single ASCII bytes, so bytes split like characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from keysweep.functions.columns import column
from keysweep.llm.shipping import ship

PIECE_BYTES = 512 << 10
PIECE_ROWS = 2000
# Words longer in bytes than this are hashed one at a time.
BLOCK = 256 << 10

# Odd 64-bit multipliers of the polynomial hashes and the finaliser of their results.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX_1 = 0xFF51AFD7ED558CCD
MIX_2 = 0xC4CEB9FE1A85EC53

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_table(separators: Sequence[int]) -> np.ndarray:
    """True for the bytes of words: all but ``separators``."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# Words [^\x20\x09-\x0D]+
SPACED = byte_table([0x20, *range(0x09, 0x0E)])


def map_pieces(
    df: DataFrame,
    columns: Sequence[str],
    func: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """``func`` on record batches of ``columns``, each with a bounded amount of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                out = func(piece)
                if out is not None and out.num_rows:
                    yield out

    ship(df.sparkSession)
    return df.select(*map(column, columns)).mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of at most ``PIECE_BYTES`` of text and ``PIECE_ROWS`` rows, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = int(np.searchsorted(ends, before + PIECE_BYTES, "right"))
        end = min(max(end, start + 1), start + PIECE_ROWS, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each one starts (one more entry than texts). NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the index of the first word of each text (one more entry than texts)."""
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < ``count`` or more."""
    known = _powers.get(base)
    if known is None or len(known[0]) < count:
        size = max(count, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        known = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)])
            for b in (base, inverse)
        )
        if size <= 2 * BLOCK:
            _powers[base] = known
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(MIX_1)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(int(np.searchsorted(ends, low + BLOCK, "right")), at + 1)
        block = data[low : int(ends[to - 1])]
        up, down = powers(base, len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = to
    return mixed(out)


def range_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int, base: int = WORD_BASE) -> np.ndarray:
    """64-bit hash of the word hashes from each start on, as many as its length says."""
    up, down = powers(base, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mixed((sums[starts + lengths] - sums[starts]) * down[starts] + np.asarray(lengths).astype(np.uint64))


def window_starts(firsts: np.ndarray, size: int) -> np.ndarray:
    """Index of the first word of every window of ``size`` consecutive words of one text."""
    counts = np.maximum(firsts[1:] - firsts[:-1] - size + 1, 0)
    return np.repeat(firsts[:-1], counts) + ranges(counts)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for every count, in one array."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes unchanged."""
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.astype(np.uint64).view(np.int64))


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {name: value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value) for name, value in columns.items()}
    )
