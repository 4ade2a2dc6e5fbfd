"""Benchmark decontamination: words of documents that occur in windows of benchmark items.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z in lower case. A window is ``size``
consecutive words of an item; an item of fewer words, but not none, is one window as a whole. A word of a document inside any
occurrence of a window is hit, and a document with a hit is contaminated.

The windows of the benchmark go to all executors as a set of hashes with their words. Every window of every document is
looked up by its hash, and each match is verified on the words. A benchmark of more than ``limit`` bytes of windows is
dealt to several sets by the hash of the window; the documents are scanned once for each, and the hits are united.

Cases: NULL and empty texts have no words; rows of one item identifier are one item; items without an identifier hit words
but are not listed; rows that repeat a document identifier are judged one by one; empty tables give no rows, and no hits.
Other columns are not read by ``contamination``; ``decontaminate`` keeps them, whatever their names.
Memory is bounded by ``limit`` and the longest text.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.shipping import ship
from keysweep.llm.staging import Stage, columns_of, free_name
from keysweep.llm.text import (
    BYTE_BASE,
    WORD_BASE,
    batch_of,
    byte_table,
    flat,
    lowered,
    map_pieces,
    range_hashes,
    signed,
    span_hashes,
    spans,
    window_starts,
)

SIZE = 10
# Most bytes of windows that are sent to every executor at once.
LIMIT = 32 << 20
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
WORDS = byte_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
FILTER_BITS = 20
# Estimated bytes of a window in memory, besides its words.
WINDOW_BYTES = 200


def tokens(texts: pa.Array):
    """Lower-cased bytes, starts, ends and hashes of words, and the index of the first word of each text."""
    data, offsets = flat(texts)
    data = lowered(data)
    starts, ends, firsts = spans(data, offsets, WORDS)
    return data, starts, ends, span_hashes(data, starts, ends, BYTE_BASE), firsts


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(hash, length, words, item) of every window of every item."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, words, firsts = tokens(piece.column("text"))
        count = np.diff(firsts)
        short = np.flatnonzero((count > 0) & (count < size))
        at = np.concatenate([window_starts(firsts, size), firsts[short]])
        length = np.concatenate([np.full(len(at) - len(short), size), count[short]]).astype(np.int64)
        item = np.searchsorted(firsts, at, "right") - 1
        raw = data.tobytes()
        joined = [b" ".join(raw[a:b] for a, b in zip(starts[i : i + n].tolist(), ends[i : i + n].tolist())).decode("utf-8", "replace") for i, n in zip(at.tolist(), length.tolist())]
        return batch_of(
            hash=signed(range_hashes(words, at, length, WORD_BASE)),
            length=length.astype(np.int32),
            words=pa.array(joined, pa.string()),
            item=piece.column("item").take(pa.array(item)),
        )

    found = map_pieces(items, ["item", "text"], find, "hash long, length int, words string, item string")
    return found.groupBy("hash", "length", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class WindowSet:
    """Windows by length and hash; equal hashes of different windows are kept apart by their words."""

    def __init__(self, rows):
        self.items: dict[tuple[int, int], dict[str, tuple[str, ...]]] = {}
        for row in rows:
            self.items.setdefault((row.length, row.hash), {})[row.words] = tuple(row.items)
        by_length: dict[int, list[int]] = {}
        for length, key in self.items:
            by_length.setdefault(length, []).append(key)
        self.hashes = {length: np.sort(np.array(keys, np.int64)).view(np.uint64) for length, keys in by_length.items()}
        self.likely = {}
        for length, keys in self.hashes.items():
            table = np.zeros(1 << FILTER_BITS, bool)
            table[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.likely[length] = table

    def lookup(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that are in the set."""
        at = np.flatnonzero(self.likely[length][hashes >> np.uint64(64 - FILTER_BITS)])
        return at[np.isin(hashes[at], self.hashes[length])]


def scan(docs: DataFrame, windows: WindowSet) -> DataFrame:
    """Per row of id and text: the words, which of them are hit (ranges), and the items."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        data, starts, ends, words, firsts = tokens(piece.column("text"))
        raw = None
        hit: list[tuple[int, int]] = []
        items: list[set[str]] = [set() for _ in range(piece.num_rows)]
        for length in sorted(known.hashes):
            at = window_starts(firsts, length)
            hashes = range_hashes(words, at, length, WORD_BASE)
            for k in known.lookup(length, hashes).tolist():
                raw = data.tobytes() if raw is None else raw
                i = int(at[k])
                text = b" ".join([raw[a:b] for a, b in zip(starts[i : i + length].tolist(), ends[i : i + length].tolist())])
                found = known.items[length, int(hashes[k : k + 1].view(np.int64)[0])].get(text.decode("utf-8", "replace"))
                if found is not None:
                    hit.append((i, i + length))
                    items[int(np.searchsorted(firsts, i, "right")) - 1].update(found)
        change = np.zeros(len(words) + 1, np.int64)
        if hit:
            np.add.at(change, [a for a, _ in hit], 1)
            np.add.at(change, [b for _, b in hit], -1)
        marked = np.cumsum(change)[:-1] > 0
        lists = [np.flatnonzero(marked[a:b]).tolist() for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
        return batch_of(
            id=piece.column("id"),
            digest=piece.column("digest"),
            n_words=np.diff(firsts).astype(np.int64),
            hits=pa.array(lists, pa.list_(pa.int32())),
            items=pa.array([sorted(s) for s in items], pa.list_(pa.string())),
        )

    return map_pieces(
        docs, ["id", "digest", "text"], find, "id long, digest long, n_words long, hits array<int>, items array<string>"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SIZE,
    limit: int = LIMIT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, digest (of the text), n_words, hits (positions of hit words), items (identifiers as
    strings, sorted)."""
    stage = Stage(docs.sparkSession, "contamination")
    windows = stage(
        item_windows(items.select(column(item_col).cast("string").alias("item"), column(item_text_col).alias("text")), size),
        "windows",
    )
    listed = F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + 60)
    weight = windows.agg(F.sum(F.octet_length("words") + listed + WINDOW_BYTES)).first()[0] or 0
    sets = max(1, ceil(weight / limit))
    docs = docs.select(
        column(id_col).cast("bigint").alias("id"), F.xxhash64(column(text_col)).alias("digest"), column(text_col).alias("text")
    )
    if sets == 1:
        return scan(docs, WindowSet(windows.toLocalIterator())).withColumnRenamed("id", "doc_id")
    dealt = F.pmod(F.xxhash64("words"), F.lit(sets))
    found = None
    for k in range(sets):
        part = stage(scan(docs, WindowSet(windows.filter(dealt == k).toLocalIterator())), f"set-{k}")
        found = part if found is None else found.union(part)
    merged = found.groupBy("id", "digest").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count("*").alias("rows"),
    )
    # A text that is repeated under its identifier had one row from each set for each repetition.
    copies = F.explode(F.sequence(F.lit(1), (F.col("rows") / sets).cast("int")))
    return merged.withColumn("copy", copies).select(F.col("id").alias("doc_id"), "digest", "n_words", "hits", "items")


def contamination_digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum of what ``contamination`` found."""
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SIZE,
    limit: int = LIMIT,
    spans_only: bool = False,
) -> DataFrame:
    """The rows of ``docs`` without a hit. With ``spans_only`` all rows stay, without their hit words.

    The white space and marks around a removed word stay as they are.
    """
    stage = Stage(docs.sparkSession, "decontaminate")
    found = contamination(docs, items, id_col, text_col, item_col, item_text_col, size, limit).filter(F.size("hits") > 0)
    own, digest, hits = (free_name(docs, n) for n in ("hit_id", "hit_digest", "hit_words"))
    marked = stage(
        found.groupBy("doc_id", "digest").agg(F.first("hits").alias("hits")).select(
            F.col("doc_id").alias(own), F.col("digest").alias(digest), F.col("hits").alias(hits)
        ),
        "contaminated",
    )
    same_text = column(id_col).cast("bigint").eqNullSafe(column(own)) & (F.xxhash64(column(text_col)) == column(digest))
    if not spans_only:
        return docs.join(marked, same_text, "left_anti")
    joined = docs.join(marked, same_text, "left").select(*columns_of(docs), column(hits))

    def strip(batches):
        for batch in batches:
            texts = [cut(t, h) for t, h in zip(batch.column(text_col).to_pylist(), batch.column(hits).to_pylist())]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).drop_columns([hits])

    ship(docs.sparkSession)
    return joined.mapInArrow(strip, docs.schema)


def cut(text: str | None, hits: list[int] | None) -> str | None:
    """``text`` without its words of the positions ``hits``."""
    if not text or not hits:
        return text
    data, starts, ends, _, _ = tokens(pa.array([text]))
    raw, at, out = text.encode(), 0, []
    for a, b in zip(starts[hits].tolist(), ends[hits].tolist()):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")
