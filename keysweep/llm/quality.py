"""Quality rules: counts of a document, fixed rules on them, and boosted trees for what the rules leave.

Words are runs of characters other than ASCII white space. Counts are those of whole texts:
``word_chars`` code points in words, ``n_symbols`` characters of ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal
an earlier line, ``n_repeat_words`` words in windows of three words that occur twice or more, the first included.
The rules reject a text of fewer than 50 words, or of which more than half of the words are repeated.

The trees learn the 0/1 quality of labelled documents from ratios of the counts. They may only think less of a document as
symbols, repeated lines or repeated words grow (monotonic constraints). At most ``most_rows`` labels, the first by a hash of the
identifier, choose the documents to learn from, of which again at most ``most_rows`` are used; every document is scored, where it
is read: nothing but these few is shuffled. Without labels only the rules decide.

Cases: NULL and empty texts have no words and fail; rows that repeat an identifier are judged one by one; a label of
a repeated identifier counts once for each row, contradicting labels all count, NULL labels do not; an empty table
gives an empty result; other columns are not read by ``quality`` and kept by ``quality_filter``, whatever their names.
Memory is bounded by the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm import boosting
from keysweep.llm.staging import Stage, bounded_sample
from keysweep.llm.text import (
    BYTE_BASE,
    SPACED,
    WORD_BASE,
    batch_of,
    flat,
    map_pieces,
    mixed,
    pieces,
    range_hashes,
    span_hashes,
    spans,
    window_starts,
)

MIN_WORDS = 50
MOST_ROWS = 20_000
REPEAT = 3
KEEP_FROM = 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_stops", "n_distinct")
# Ratios the trees see, and their monotonic constraints.
FEATURES = {"words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "line_length": 0, "upper": 0, "digits": 0, "marks": 0, "stops": 0, "distinct": 0}


def table_of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


UPPER, DIGITS = table_of(bytes(range(0x41, 0x5B))), table_of(bytes(range(0x30, 0x3A)))
MARKS, STOPS = table_of(b"!?;:,\"'()[]{}"), table_of(b".")


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true bytes of each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated(keys: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each key, whether its group holds it twice or more."""
    both = mixed(keys ^ (groups.astype(np.uint64) * np.uint64(WORD_BASE)))
    order = np.argsort(both, kind="stable")
    equal = both[order][1:] == both[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= equal
    out[order[:-1]] |= equal
    return out


def later_copies(keys: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each key, whether its group holds it earlier."""
    both = mixed(keys ^ (groups.astype(np.uint64) * np.uint64(WORD_BASE)))
    order = np.argsort(both, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = both[order][1:] == both[order][:-1]
    return out


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text."""
    data, offsets = flat(texts)
    starts, ends, firsts = spans(data, offsets, SPACED)
    words = span_hashes(data, starts, ends, BYTE_BASE)
    rows = len(offsets) - 1
    text = np.repeat(np.arange(rows), np.diff(firsts))
    head = ((data & 0xC0) != 0x80) & SPACED[data]
    windows = window_starts(firsts, REPEAT)
    again = windows[repeated(range_hashes(words, windows, REPEAT), text[windows])]
    in_repeat = np.zeros(len(words), bool)
    for k in range(REPEAT):
        in_repeat[again + k] = True
    # Lines that hold a word, hashed with their white space; a line break belongs to no line.
    breaks = data != 0x0A
    first, last = breaks.copy(), breaks.copy()
    first[1:] &= ~breaks[:-1]
    last[:-1] &= ~breaks[1:]
    filled = np.flatnonzero(offsets[:-1] < offsets[1:])
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads], last[tails] = breaks[heads], breaks[tails]
    line_starts, line_ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_text = np.searchsorted(offsets, line_starts, "right") - 1
    copies = later_copies(span_hashes(data, line_starts, line_ends, BYTE_BASE), line_text)
    return {
        "n_words": np.diff(firsts).astype(np.int64),
        "word_chars": per_text(head, offsets),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_text[copies], minlength=rows),
        "n_repeat_words": np.bincount(text[in_repeat], minlength=rows),
        "n_lines": np.bincount(line_text, minlength=rows),
        "n_upper": per_text(UPPER[data], offsets),
        "n_digits": per_text(DIGITS[data], offsets),
        "n_marks": per_text(MARKS[data], offsets),
        "n_stops": per_text(STOPS[data], offsets),
        "n_distinct": np.bincount(text[~later_copies(words, text)], minlength=rows),
    }


def feature_rows(counts: dict[str, np.ndarray]) -> np.ndarray:
    c = {k: np.asarray(v, float) for k, v in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    named = {
        "words": np.log1p(c["n_words"]),
        "word_length": c["word_chars"] / words,
        "symbols": c["n_symbols"] / chars,
        "dup_lines": c["n_dup_lines"] / lines,
        "repeats": c["n_repeat_words"] / words,
        "line_length": np.log1p(c["n_words"] / lines),
        "upper": c["n_upper"] / chars,
        "digits": c["n_digits"] / chars,
        "marks": c["n_marks"] / chars,
        "stops": c["n_stops"] / words,
        # A sample of any length has fewer distinct words the longer it is.
        "distinct": np.log1p(c["n_distinct"]) / np.log1p(words),
    }
    return np.stack([named[k] for k in FEATURES], axis=1)


def verdicts(counts: dict[str, np.ndarray], trees: boosting.Trees, keep_from: float) -> dict[str, np.ndarray]:
    """Whether the rules reject each document, the score of the trees, and whether it is kept."""
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    score = trees.probability(feature_rows(counts))
    return {"base_failed": failed, "score": score, "kept": ~failed & ((score >= keep_from) | (len(trees.roots) == 0))}


def fit(rows: DataFrame, labels: DataFrame, stage: Stage, most_rows: int) -> boosting.Trees:
    """Trees for documents (id, digest, text) with a label (id, quality) that pass the rules."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = counts_of(piece.column("text"))
        columns = {k: piece.column(k) for k in ("id", "digest", "quality")}
        return batch_of(**columns, **{k: found[k].astype(np.int64) for k in COUNTS})

    chosen = stage(bounded_sample(labels.filter("quality is not null"), most_rows, F.col("id"), F.col("quality")), "labels")
    labelled = rows.join(F.broadcast(chosen), "id")
    schema = "id long, digest long, quality int, " + ", ".join(f"{c} long" for c in COUNTS)
    counts = stage(map_pieces(labelled, ["id", "digest", "quality", "text"], find, schema), "labelled")
    passed = counts.filter((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= 50 * F.col("n_words")))
    # Rows may repeat an identifier, so those of a bounded number of labels are not yet a bounded number.
    sample = bounded_sample(passed, most_rows, F.col("id"), F.col("digest"), F.col("quality")).select("quality", *COUNTS).toPandas()
    x = feature_rows({k: sample[k].to_numpy() for k in COUNTS})
    return boosting.train(x, sample["quality"].to_numpy().astype(float), list(FEATURES.values()))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_rows: int):
    """The trees, sent to all executors."""
    rows = docs.select(
        column(id_col).cast("bigint").alias("id"), F.xxhash64(column(text_col)).alias("digest"), column(text_col).alias("text")
    )
    labels = labels.select(column(id_col).cast("bigint").alias("id"), (column(label_col) > 0).cast("int").alias("quality"))
    trees = fit(rows, labels, Stage(docs.sparkSession, "quality"), most_rows)
    return docs.sparkSession.sparkContext.broadcast(trees)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_rows: int = MOST_ROWS,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, score (0 to 1) and kept."""
    shared = fitted(docs, labels, id_col, text_col, label_col, most_rows)

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = counts_of(piece.column("text"))
        named = {k: v.astype(np.int64) for k, v in found.items()}
        return batch_of(doc_id=piece.column("id"), **named, **verdicts(found, shared.value, keep_from))

    rows = docs.select(column(id_col).cast("bigint").alias("id"), column(text_col).alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return map_pieces(rows, ["id", "text"], find, schema)


def quality_filter(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_rows: int = MOST_ROWS,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """The rows of ``docs`` that are kept, judged where they are read."""
    shared = fitted(docs, labels, id_col, text_col, label_col, most_rows)

    def keep(batches):
        for batch in batches:
            for piece in pieces(batch, text_col):
                found = verdicts(counts_of(piece.column(text_col)), shared.value, keep_from)
                yield piece.filter(pa.array(found["kept"]))

    return docs.mapInArrow(keep, docs.schema)
