"""Substring dedup by seed and extend: passages that repeat an earlier passage are removed.

A window is ``length`` consecutive words of one text, a word being a run of characters other than ASCII white space.
Every word covered by a window that also starts earlier is removed, earlier meaning a smaller identifier (NULL is the
smallest; texts that share an identifier are told apart and ordered by a 64-bit hash) or a smaller position in the same text. Windows
are judged on the input.

1. Seeds. Each window selects the least hash among its groups of ``seed_words`` words, the leftmost on a tie, so equal
   windows select the same seed at the same place. Successive windows mostly select the same one: a seed stands for a
   run of windows, about one run for every eight words. Seeds that occur once are dropped by counting.
2. Extension of whole runs. Runs with one seed and one hash of all words they cover are copies of each other. All but
   the earliest are repeats as a whole.
3. Extension word by word. Where one seed has different runs, windows of the earliest copy of each are compared one by
   one, by the hash of their words under their seed. That yields both ends of a maximal repeat.

Copies are counted before they are shuffled, and the joins are sort-merge joins of stored tables, of which Spark splits
hot keys. No pairs are formed: each occurrence meets the earliest one only. Windows are equal if the 64-bit hashes of their
seed and of all their words are; the words themselves are not compared again.

Cases: a NULL or empty text has no words; a text of fewer than ``length`` words loses nothing; rows that repeat an
identifier and a text all get the same result, and do not count as earlier than each other; an empty table gives an
empty result; other columns are not read. Memory is bounded by the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.staging import Stage, text_digest
from keysweep.llm.text import (
    BYTE_BASE,
    SPACED,
    WORD_BASE,
    batch_of,
    flat,
    map_pieces,
    range_hashes,
    ranges,
    signed,
    span_hashes,
    spans,
    window_starts,
)

LENGTH = 20
SEED_WORDS = 6
# Fixed value: the multiplier of seed hashes, another than that of window hashes.
SEED_BASE = 0x165667B19E3779F9


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in each window of ``width``, by doubling."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def seed_runs(words: np.ndarray, firsts: np.ndarray, length: int, seed_words: int):
    """Runs of windows that select the same seed: text, seed hash, hash of the covered words, first window, windows."""
    windows = window_starts(firsts, length)
    if not len(windows):
        return None
    grams = range_hashes(words, np.arange(len(words) - seed_words + 1), seed_words, SEED_BASE)
    chosen = leftmost_least(grams, length - seed_words + 1)[windows]
    text = np.searchsorted(firsts, windows, "right") - 1
    new = np.ones(len(windows), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(windows)))
    start = windows[at]
    return text[at], grams[chosen[at]], range_hashes(words, start, count + length - 1), start, count


def runs_of(docs: DataFrame, length: int, seed_words: int) -> DataFrame:
    def find(piece: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = flat(piece.column("text"))
        starts, ends, firsts = spans(data, offsets, SPACED)
        found = seed_runs(span_hashes(data, starts, ends, BYTE_BASE), firsts, length, seed_words)
        if found is None:
            return None
        text, seed, span, start, count = found
        return batch_of(
            seed=signed(seed),
            span=signed(span),
            id=piece.column("id").take(pa.array(text)),
            digest=piece.column("digest").take(pa.array(text)),
            start=(start - firsts[text]).astype(np.int32),
            windows=count.astype(np.int32),
        )

    return map_pieces(docs, ["id", "digest", "text"], find, "seed long, span long, id long, digest long, start int, windows int")


def windows_of(docs: DataFrame, length: int) -> DataFrame:
    """The windows of chosen runs; ``runs`` lists their seeds, first windows and numbers of windows."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(piece.column("text"))
        starts, ends, firsts = spans(data, offsets, SPACED)
        words = span_hashes(data, starts, ends, BYTE_BASE)
        runs = piece.column("runs")
        text = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy())
        run = runs.flatten()
        seed, start, count = (run.field(k).to_numpy(zero_copy_only=False) for k in ("seed", "start", "windows"))
        text, seed = np.repeat(text, count), np.repeat(seed, count)
        start = np.repeat(start, count) + ranges(count)
        return batch_of(
            seed=seed,
            window=signed(range_hashes(words, firsts[text] + start, length, WORD_BASE)),
            id=piece.column("id").take(pa.array(text)),
            digest=piece.column("digest").take(pa.array(text)),
            start=start.astype(np.int32),
        )

    return map_pieces(docs, ["id", "digest", "text", "runs"], find, "seed long, window long, id long, digest long, start int")


def repeated_ranges(docs: DataFrame, stage: Stage, length: int, seed_words: int) -> DataFrame:
    """Ranges of words, end exclusive, that repeat an earlier passage: id, digest, start, end."""
    place = F.struct("id", "digest", "start")
    runs = runs_of(docs, length, seed_words)
    often = stage(runs.groupBy("seed").count().filter("count > 1").select("seed"), "seeds")
    hits = stage(runs.join(often.hint("merge"), "seed", "left_semi"), "runs")
    classes = stage(
        hits.groupBy("seed", "span").agg(F.min(place).alias("first"), F.count("*").alias("copies"), F.first("windows").alias("windows")),
        "classes",
    )
    copied = classes.filter("copies > 1").select("seed", "span", "first")
    whole = hits.join(copied.hint("merge"), ["seed", "span"]).filter(place > F.col("first")).select(
        "id", "digest", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end")
    )
    many = stage(classes.groupBy("seed").count().filter("count > 1").select("seed"), "many")
    chosen = (
        classes.join(many.hint("merge"), "seed", "left_semi")
        .select("first.id", "first.digest", F.struct("seed", "first.start", "windows").alias("run"))
        .groupBy("id", "digest")
        .agg(F.collect_list("run").alias("runs"))
    )
    # Repeated rows of one text would list their windows twice, which does not change the earliest start.
    texts = docs.join(chosen, docs["id"].eqNullSafe(chosen["id"]) & (docs["digest"] == chosen["digest"])).select(
        docs["id"], docs["digest"], "text", "runs"
    )
    windows = stage(windows_of(texts, length), "windows")
    first = stage(
        windows.groupBy("seed", "window").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").drop("last"),
        "firsts",
    )
    part = windows.join(first.hint("merge"), ["seed", "window"]).filter(place > F.col("first")).select(
        "id", "digest", "start", (F.col("start") + length).alias("end")
    )
    return whole.union(part)


def covered(found: pa.ListArray, firsts: np.ndarray) -> np.ndarray:
    """For every word of all texts, whether a range of its text holds it."""
    counts = np.nan_to_num(found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
    base = np.repeat(firsts[:-1], counts)
    each = found.flatten()
    change = np.zeros(int(firsts[-1]) + 1, np.int64)
    np.add.at(change, base + each.field("start").to_numpy(zero_copy_only=False), 1)
    np.add.at(change, base + each.field("end").to_numpy(zero_copy_only=False), -1)
    return np.cumsum(change)[:-1] > 0


def kept_texts(docs: DataFrame) -> DataFrame:
    """Per row of id, text and ranges: the words that stay, joined by one space."""

    def keep(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(piece.column("text"))
        starts, ends, firsts = spans(data, offsets, SPACED)
        gone = covered(piece.column("ranges"), firsts)
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(firsts[:-1], len(gone)))
        removed[firsts[1:] == firsts[:-1]] = 0
        raw, texts = data.tobytes(), []
        for i in range(piece.num_rows):
            own = np.flatnonzero(~gone[firsts[i] : firsts[i + 1]]) + firsts[i]
            texts.append(b" ".join([raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())]))
        return batch_of(
            doc_id=piece.column("id"),
            n_words=np.diff(firsts).astype(np.int64),
            n_removed=removed,
            kept=pa.array(texts, pa.binary()).cast(pa.string()),
            kept_sha256=[hashlib.sha256(t).hexdigest() for t in texts],
        )

    return map_pieces(
        docs, ["id", "text", "ranges"], keep, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    )


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed_words: int = SEED_WORDS
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the text that stays) and its kept_sha256."""
    if not 1 <= seed_words <= length:
        raise ValueError("seed_words must be between 1 and length")
    docs = docs.select(column(id_col).cast("bigint").alias("id"), text_digest(text_col).alias("digest"), column(text_col).alias("text"))
    stage = Stage(docs.sparkSession, "substring-dedup")
    found = repeated_ranges(docs, stage, length, seed_words)
    found = stage(found.groupBy("id", "digest").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "ranges")
    joined = docs.join(
        found, docs["id"].eqNullSafe(found["id"]) & (docs["digest"] == found["digest"]), "left"
    ).select(docs["id"], "text", "ranges")
    return kept_texts(joined)
