"""Line dedup: lines that equal an earlier line, or are one word away from it, are removed.

Lines are separated by ``\\n``; their words are runs of characters other than ASCII white space. Lines without a word
always stay. Two lines are close if their words are equal or if, both having at least ``min_words`` words, one becomes
the other by inserting, deleting or replacing one word. A line is removed if an earlier line is close to it, earlier
meaning a smaller identifier (NULL is the smallest; texts of one identifier are told apart and ordered by a 64-bit hash) or the same text
and a smaller number. Lines are judged on the input, whether or not the earlier one is itself removed.

Lines with the same words are one class from the start. Classes are linked by their deletion neighbourhoods:

1. Which lines can have a close one at all? If one word differs, the first q or the last q words are the same, q being
   the largest power of two up to half of the shorter line. Each class is keyed by both. Classes that share no key drop out.
2. The others emit the hash of every variant with one word deleted on the side that may differ. Variants deleted at the
   same place that are equal belong to lines that differ in that word. A variant that equals an undeleted line belongs
   to a line with one word more. So all members of such a group are close to its earliest one, or to the undeleted line,
   and each is joined to that one alone: no pairs of members are formed.
3. The edit distance of every joined pair is verified on the words. The earliest close line is the least of its partners.

With ``words_per_edit`` the bound grows with the line: the shorter of two lines, of n words, allows n // ``words_per_edit`` edits of
a word, whatever ``min_words`` is, and from ``min_words`` on one at least. One of k + 1 pieces of the shorter line is then found
unchanged in the longer one, at most k places away. So lines emit their pieces and all their windows of the lengths that pieces have,
a few for each word; pieces meet windows, and the edit distance of every such pair is verified in a band. A piece that is common
to many lines gives all pairs of them: the wider bound costs more, and is off by default.

Keys are reduced to their least and greatest class before they are shuffled; joins are sort-merge joins of
stored tables, of which Spark splits hot keys.

Cases: a NULL text stays NULL and has no lines; rows that repeat an identifier and a text all get the same result and
are not earlier than each other; an empty table gives an empty result; other columns are kept by
``line_dedup``, whatever their names. Memory is bounded by the longest text.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.llm.shipping import ship
from keysweep.llm.staging import Stage, columns_of, free_name, text_digest
from keysweep.llm.text import (
    BYTE_BASE,
    SPACED,
    WORD_BASE,
    batch_of,
    flat,
    map_pieces,
    powers,
    range_hashes,
    signed,
    span_hashes,
    spans,
)

MIN_WORDS = 8
# Multipliers of the hashes that tell first words from last words, and of the second half of a class.
FIRST_BASE = 0x27D4EB2F165667C5
LAST_BASE = 0x85EBCA77C2B2AE63
CLASS_BASE = 0xA0761D6478BD642F
FIRST, LAST = 0, 1


def lines_of(texts: pa.Array):
    """Bytes, offsets of lines, and the text of each line."""
    data, offsets = flat(texts)
    breaks = np.flatnonzero(data == 0x0A)
    sizes = np.diff(offsets)
    lines_before = np.searchsorted(breaks, offsets)
    text = np.repeat(np.arange(len(sizes)), np.diff(lines_before) + 1)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # A break at the end of one text and the start of the next fall on the same byte; sorting keeps both.
    return data, starts, text, lines_before


def half(count: np.ndarray) -> np.ndarray:
    """Largest power of two up to half of ``count``."""
    return (1 << np.floor(np.log2(np.maximum(count, 2) // 2)).astype(np.int64)).astype(np.int64)


def word_lines(texts: pa.Array):
    """Word hashes, and for every line with a word: text, number in its text, first word, number of words."""
    data, starts, text, before = lines_of(texts)
    word_starts, word_ends, _ = spans(data, np.append(starts, len(data)), SPACED)
    words = span_hashes(data, word_starts, word_ends, BYTE_BASE)
    # An empty line shares its start with the line after it, which owns the words.
    first = np.searchsorted(word_starts, starts)
    count = np.diff(np.append(first, len(words)))
    number = np.arange(len(text)) - (before[:-1] + np.arange(len(before) - 1))[text]
    has = np.flatnonzero(count > 0)
    return data, word_starts, word_ends, words, text[has], number[has], first[has], count[has]


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """Every line with a word: its class, place, and the hashes of its first and last words."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        _, _, _, words, text, number, first, count = word_lines(piece.column("text"))
        q = half(count)
        longer = half(count - 1)
        keys = []
        for size, base, where in ((q, FIRST_BASE, FIRST), (q, LAST_BASE, LAST), (longer, FIRST_BASE, FIRST), (longer, LAST_BASE, LAST)):
            at = first if where == FIRST else first + count - size
            keys.append(range_hashes(words, np.minimum(at, len(words) - size), size, base).view(np.int64))
        # The second pair of keys is for lines with one word less, where their half is another.
        other = (count > min_words) & (longer != q)
        keyed = count >= min_words
        return batch_of(
            c1=signed(range_hashes(words, first, count, WORD_BASE)),
            c2=signed(range_hashes(words, first, count, CLASS_BASE)),
            id=piece.column("id").take(pa.array(text)),
            digest=piece.column("digest").take(pa.array(text)),
            line=number.astype(np.int32),
            k1=pa.array(keys[0], mask=~keyed),
            k2=pa.array(keys[1], mask=~keyed),
            k3=pa.array(keys[2], mask=~(keyed & other)),
            k4=pa.array(keys[3], mask=~(keyed & other)),
        )

    schema = "c1 long, c2 long, id long, digest long, line int, k1 long, k2 long, k3 long, k4 long"
    return map_pieces(docs, ["id", "digest", "text"], find, schema)


def suspects(classes: DataFrame, stage: Stage) -> DataFrame:
    """(c1, c2, sides): classes that share a key with another, and the sides that agree, with the length that does."""
    listed = F.array(
        *[F.struct(F.col(k).alias("key"), F.lit(side).alias("side"), F.lit(other).alias("other")) for k, side, other in (("k1", FIRST, 0), ("k2", LAST, 0), ("k3", FIRST, 1), ("k4", LAST, 1))]
    )
    keyed = classes.filter("k1 is not null").select(F.struct("c1", "c2").alias("c"), F.explode(listed).alias("k"))
    keyed = keyed.select("c", "k.*").filter("key is not null")
    shared = stage(
        keyed.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least <> most").select("key"), "shared"
    )
    met = keyed.join(shared.hint("merge"), "key", "left_semi")
    return stage(met.groupBy("c").agg(F.collect_set(F.struct("side", "other")).alias("sides")).select("c.*", "sides"), "suspects")


def suspect_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of wanted lines (id, digest, lines: array of line, c1, c2, sides), joined by one space."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"c1": [], "c2": [], "id": [], "digest": [], "line": [], "sides": [], "words": []}
        for i, lines in zip(piece.column("id").to_pylist(), piece.to_pylist()):
            parts = (lines["text"] or "").encode().split(b"\n")
            for line in lines["lines"]:
                out["words"].append(b" ".join(parts[line["line"]].split()).decode("utf-8", "replace"))
                out["id"].append(i)
                out["digest"].append(lines["digest"])
                for name in ("c1", "c2", "line", "sides"):
                    out[name].append(line[name])
        sides = pa.array(out["sides"], pa.list_(pa.struct([("side", pa.int32()), ("other", pa.int32())])))
        return batch_of(
            c1=pa.array(out["c1"], pa.int64()),
            c2=pa.array(out["c2"], pa.int64()),
            id=pa.array(out["id"], pa.int64()),
            digest=pa.array(out["digest"], pa.int64()),
            line=pa.array(out["line"], pa.int32()),
            sides=sides,
            words=pa.array(out["words"], pa.string()),
        )

    joined = docs.join(
        wanted, docs["id"].eqNullSafe(wanted["id"]) & (docs["digest"] == wanted["digest"])
    ).select(docs["id"], docs["digest"], "text", "lines")
    schema = "c1 long, c2 long, id long, digest long, line int, sides array<struct<side:int,other:int>>, words string"
    return map_pieces(joined, ["id", "digest", "text", "lines"], find, schema)


def neighbourhood(texts: DataFrame) -> DataFrame:
    """(key, at, place, c1, c2): hashes of the variants of each line with one word deleted, and of the line itself.

    ``at`` is the place of the deletion for the comparison with lines of the same length, -1 for that with shorter
    ones, and -2 for the undeleted line.
    """

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(piece.column("words"))
        starts, ends, firsts = spans(data, offsets, SPACED)
        words = span_hashes(data, starts, ends, BYTE_BASE)
        count = np.diff(firsts)
        row, at = [], []
        for i, (n, sides) in enumerate(zip(count.tolist(), piece.column("sides").to_pylist())):
            # The words that may differ: after the first q that agree, or before the last q.
            low, high = n, 0
            for s in sides:
                q = int(half(np.array([n - s["other"]]))[0])
                low, high = (min(low, q), n) if s["side"] == FIRST else (0, max(high, n - q))
            row.append(np.full(high - low, i))
            at.append(np.arange(low, high))
        row, at = np.concatenate(row), np.concatenate(at)
        before = range_hashes(words, firsts[row], at, FIRST_BASE)
        after = range_hashes(words, firsts[row] + at + 1, count[row] - at - 1, LAST_BASE)
        whole = shortened(words, firsts, count, row, at)
        every = np.arange(len(count))
        undeleted = poly(words, firsts[:-1], count)
        rows = np.concatenate([row, row, every])
        take = pa.array(rows)
        return batch_of(
            key=signed(np.concatenate([before * np.uint64(LAST_BASE) ^ after, whole, undeleted])),
            at=np.concatenate([at, np.full(len(at), -1), np.full(len(every), -2)]).astype(np.int32),
            **{name: piece.column(name).take(take) for name in ("id", "digest", "line", "c1", "c2")},
        )

    schema = "key long, at int, id long, digest long, line int, c1 long, c2 long"
    return map_pieces(texts, ["c1", "c2", "id", "digest", "line", "sides", "words"], find, schema, text="words")


def poly(words: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hash of a word sequence from which that of the sequence without one word can be computed."""
    up, down = powers(CLASS_BASE, len(words) + 2)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return (sums[start + count] - sums[start]) * down[start]


def shortened(words: np.ndarray, firsts: np.ndarray, count: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``poly`` of each line without its word ``at``."""
    up, _ = powers(CLASS_BASE, len(words) + 2)
    start = firsts[row]
    return poly(words, start, at) + poly(words, start + at + 1, count[row] - at - 1) * up[at]


def partners(keys: DataFrame, texts: DataFrame, stage: Stage) -> DataFrame:
    """(c1, c2, place): of each class, the places of verified close lines, the earliest of them included."""
    place, cls = F.struct("id", "digest", "line"), F.struct("c1", "c2")
    member = F.struct(place.alias("place"), cls.alias("c"))
    groups = keys.withColumn("family", F.greatest("at", F.lit(-1))).groupBy("key", "family").agg(
        F.min(F.when(F.col("at") != -2, member)).alias("cut"),
        F.min(F.when(F.col("at") == -2, member)).alias("uncut"),
        F.max(F.when(F.col("at") != -2, member)).alias("last"),
    )
    # Lines that differ in one word look to the earliest of them; with a shorter line, both sides look to the other.
    groups = stage(groups.filter("(family >= 0 and cut.c <> last.c) or (family = -1 and cut is not null and uncut is not null)"), "groups")
    met = keys.withColumn("family", F.greatest("at", F.lit(-1))).join(groups.drop("last").hint("merge"), ["key", "family"])
    other = F.when((F.col("at") >= 0) | (F.col("at") == -2), F.col("cut")).otherwise(F.col("uncut"))
    pairs = met.select("c1", "c2", other.alias("o")).filter((F.col("o.c.c1") != F.col("c1")) | (F.col("o.c.c2") != F.col("c2")))
    pairs = stage(pairs.select("c1", "c2", F.col("o.c.c1").alias("d1"), F.col("o.c.c2").alias("d2"), "o.place").distinct(), "pairs")
    own = texts.select("c1", "c2", F.col("words").alias("w1"))
    others = texts.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), F.col("words").alias("w2"))
    both = pairs.join(own.hint("merge"), ["c1", "c2"]).join(others.hint("merge"), ["d1", "d2"])
    return verified(both)


def verified(pairs: DataFrame) -> DataFrame:
    def check(batches):
        for batch in batches:
            close = [one_edit(a.split(" "), b.split(" ")) for a, b in zip(batch.column("w1").to_pylist(), batch.column("w2").to_pylist())]
            yield batch.filter(pa.array(close, pa.bool_())).select(["c1", "c2", "place"])

    ship(pairs.sparkSession)
    schema = "c1 long, c2 long, place struct<id:long,digest:long,line:int>"
    return pairs.select("c1", "c2", "place", "w1", "w2").mapInArrow(check, schema)


def one_edit(a: list[str], b: list[str]) -> bool:
    """Whether at most one word has to be inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    rest_a, rest_b = a[same:], b[same:]
    if len(a) == len(b):
        return rest_a[1:] == rest_b[1:]
    return rest_a[1:] == rest_b if len(a) > len(b) else rest_a == rest_b[1:]


def edits_of(count: int, min_words: int, words_per_edit: int) -> int:
    """Edits that a line of ``count`` words allows in comparison with one as long or longer."""
    return max(count // words_per_edit, int(count >= min_words))


@lru_cache(10_000)
def piece_sizes(count: int, min_words: int, words_per_edit: int) -> list[int]:
    """Lengths of the pieces of all lines that a line of ``count`` words may be close to and not shorter than."""
    found, shorter = set(), count
    while shorter and shorter + (k := edits_of(shorter, min_words, words_per_edit)) >= count:
        if k:
            found |= {shorter // (k + 1), -(-shorter // (k + 1))}
        shorter -= 1
    return sorted(found)


def piece_keys(texts: DataFrame, min_words: int, words_per_edit: int) -> DataFrame:
    """(key, piece, edits, n, at, c1, c2): pieces of each line and its windows that a piece of a shorter line may equal."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(batch.column("words"))
        starts, ends, firsts = spans(data, offsets, SPACED)
        words = span_hashes(data, starts, ends, BYTE_BASE)
        none = np.empty(0, np.int64)
        row, at, size, edits = [none], [none], [none], [none]

        def add(i: int, places: np.ndarray, length, k: int) -> None:
            for out, value in ((row, i), (size, length), (edits, k)):
                out.append(np.broadcast_to(value, len(places)))
            at.append(places)

        for i, n in enumerate(np.diff(firsts).tolist()):
            k = edits_of(n, min_words, words_per_edit)
            if k:
                bounds = n * np.arange(k + 2) // (k + 1)
                add(i, bounds[:-1], np.diff(bounds), k)
            for length in piece_sizes(n, min_words, words_per_edit):
                add(i, np.arange(n - length + 1), length, 0)
        row, at, size, edits = map(np.concatenate, (row, at, size, edits))
        take = pa.array(row)
        return batch_of(
            key=signed(range_hashes(words, firsts[row] + at, size)),
            edits=edits.astype(np.int32),
            n=np.diff(firsts)[row].astype(np.int32),
            at=at.astype(np.int32),
            **{name: batch.column(name).take(take) for name in ("c1", "c2")},
        )

    schema = "key long, edits int, n int, at int, c1 long, c2 long"
    return map_pieces(texts, ["c1", "c2", "words"], find, schema, text="words")


def far_partners(texts: DataFrame, stage: Stage, min_words: int, words_per_edit: int) -> DataFrame:
    """(c1, c2, place): of each class, the places of all close lines by the bound that grows with the line."""
    cls = F.struct("c1", "c2")
    keys = stage(piece_keys(texts, min_words, words_per_edit), "pieces")
    groups = keys.groupBy("key").agg(F.max("edits").alias("most"), F.min(cls).alias("least"), F.max(cls).alias("last"))
    shared = stage(groups.filter("most > 0 and least <> last").select("key"), "shared")
    met = stage(keys.join(shared.hint("merge"), "key", "left_semi"), "met")
    windows = met.filter("edits = 0").select("key", F.col("n").alias("m"), F.col("at").alias("there"), F.col("c1").alias("d1"), F.col("c2").alias("d2"))
    near = "m between n and n + edits and abs(at - there) <= edits and (m > n or c1 < d1 or (c1 = d1 and c2 < d2))"
    pairs = met.filter("edits > 0").join(windows.hint("merge"), "key").filter(near)
    pairs = stage(pairs.select("c1", "c2", "d1", "d2", "edits").distinct(), "pairs")
    place = F.struct("id", "digest", "line")
    own = texts.select("c1", "c2", place.alias("p1"), F.col("words").alias("w1"))
    others = texts.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), place.alias("p2"), F.col("words").alias("w2"))
    both = pairs.join(own.hint("merge"), ["c1", "c2"]).join(others.hint("merge"), ["d1", "d2"])
    names = ["c1", "c2", "p1", "d1", "d2", "p2"]

    def check(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("w1", "w2", "edits"))
            yield batch.filter(pa.array([within(a.split(" "), b.split(" "), k) for a, b, k in zip(*columns)], pa.bool_())).select(names)

    ship(texts.sparkSession)
    struct = "struct<id:long,digest:long,line:int>"
    close = both.select(*names, "w1", "w2", "edits").mapInArrow(check, f"c1 long, c2 long, p1 {struct}, d1 long, d2 long, p2 {struct}")
    sides = F.array(F.struct("c1", "c2", F.col("p2").alias("place")), F.struct(F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.col("p1").alias("place")))
    return close.select(F.explode(sides).alias("side")).select("side.*")


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether the edit distance of word lists is at most ``most``; only places that far from the diagonal are looked at."""
    if abs(len(a) - len(b)) > most:
        return False
    far = most + 1
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        last, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                row[j] = i
                continue
            row[j] = min(last.get(j, far) + 1, row.get(j - 1, far) + 1, last.get(j - 1, far) + (x != b[j - 1]))
        if min(row.values()) > most:
            return False
    return row[len(b)] <= most


def removed_lines(docs: DataFrame, stage: Stage, min_words: int, words_per_edit: int | None = None) -> DataFrame:
    """(id, digest, gone): numbers of the lines to remove, for each text that loses any."""
    place = F.struct("id", "digest", "line")
    lines = stage(line_table(docs, min_words), "lines")
    classes = stage(
        lines.groupBy("c1", "c2").agg(
            F.min(place).alias("first"), F.max(place).alias("last"), *[F.first(k).alias(k) for k in ("k1", "k2", "k3", "k4")]
        ),
        "classes",
    )
    if words_per_edit is None:
        found = suspects(classes, stage)
    else:
        # Lines that allow no edit may still be the longer ones of a pair; all are looked at.
        found = classes.select("c1", "c2", F.array().cast("array<struct<side:int,other:int>>").alias("sides"))
    wanted = found.join(classes.select("c1", "c2", "first").hint("merge"), ["c1", "c2"]).select(
        "first.id", "first.digest", F.struct("first.line", "c1", "c2", "sides").alias("line")
    )
    wanted = wanted.groupBy("id", "digest").agg(F.collect_set("line").alias("lines"))
    texts = stage(suspect_texts(docs, wanted).dropDuplicates(["c1", "c2"]), "texts")
    if words_per_edit is None:
        near = partners(stage(neighbourhood(texts), "variants"), texts, stage)
    else:
        near = far_partners(texts, stage, min_words, words_per_edit)
    close = stage(near.groupBy("c1", "c2").agg(F.min("place").alias("close")), "close")
    earliest = classes.join(close.hint("merge"), ["c1", "c2"], "left").select(
        "c1", "c2", "last", F.least("first", F.coalesce("close", "first")).alias("earliest")
    )
    # Classes of one line without a close one lose nothing and need not meet their lines.
    earliest = stage(earliest.filter("last > earliest").drop("last"), "earliest")
    gone = lines.join(earliest.hint("merge"), ["c1", "c2"]).filter(place > F.col("earliest"))
    return stage(gone.groupBy("id", "digest").agg(F.collect_set("line").alias("gone")), "gone")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    emptied: bool = True,
    count_col: str | None = None,
    words_per_edit: int | None = None,
) -> DataFrame:
    """``docs`` without the removed lines, and with their number in a new column ``count_col`` if it is given.

    Texts that lose all their words stay as rows, unless ``emptied`` is false. Without ``words_per_edit`` one edit is allowed at most.
    """
    if min_words < 4:
        raise ValueError("min_words must be at least 4")
    if words_per_edit is not None and words_per_edit < 2:
        raise ValueError("words_per_edit must be at least 2")
    if count_col and count_col in docs.columns:
        raise ValueError(f"there is a column {count_col} already")
    stage = Stage(docs.sparkSession, "line-dedup")
    plain = docs.select(column(id_col).cast("bigint").alias("id"), text_digest(text_col).alias("digest"), column(text_col).alias("text"))
    gone = removed_lines(plain, stage, min_words, words_per_edit)
    own, digest, lines = (free_name(docs, n) for n in ("line_id", "line_digest", "line_gone"))
    gone = gone.select(F.col("id").alias(own), F.col("digest").alias(digest), F.col("gone").alias(lines))
    met = column(id_col).cast("bigint").eqNullSafe(column(own)) & (text_digest(text_col) == column(digest))
    joined = docs.join(gone, met, "left").select(*columns_of(docs), column(lines))

    def strip(batches):
        for batch in batches:
            lists = batch.column(lines)
            count = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int64())
            texts, stay = batch.column(text_col).to_pylist(), np.ones(batch.num_rows, bool)
            for i in np.flatnonzero(count.to_numpy(zero_copy_only=False)).tolist():
                drop = set(lists[i].as_py())
                texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in drop)
                stay[i] = emptied or bool(texts[i].encode().split())
            at = batch.schema.get_field_index(text_col)
            field = batch.schema.field(at)
            batch = batch.set_column(at, field, pa.array(texts, field.type)).drop_columns([lines])
            if count_col:
                batch = batch.append_column(count_col, count)
            yield batch.filter(pa.array(stay))

    ship(docs.sparkSession)
    more = [T.StructField(count_col, T.LongType())] if count_col else []
    return joined.mapInArrow(strip, T.StructType([*docs.schema.fields, *more]))


def line_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept_sha256 of the lines that stay, joined by line breaks (NULL: empty)."""
    text = F.coalesce(column(text_col), F.lit(""))
    numbered = docs.select(
        column(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.size(F.split(text, "\n")).cast("bigint").alias("n_lines")
    )
    after = line_dedup(numbered, min_words=min_words, count_col="n_removed")
    return after.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
