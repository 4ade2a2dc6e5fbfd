"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, and each run of characters that are not letters becomes one mark. Its n-grams of one to three
characters, marks included, are hashed to ``buckets``. Training sums the buckets of every training document by language, as
one aggregation; the smoothed logarithms form a matrix of languages by buckets, which goes to all executors. Scoring adds the
matrix columns of the n-grams of each document and the logarithm of the language's share of documents.

Every fourth document by CRC-32 of its identifier is held out of training. The language is only read for training.
The matrix has a fixed number of buckets. More than ``most_languages`` languages are dealt to several matrices; the documents
are scored with one after the other, and the best language and the sum of all chances are united.

Cases: a NULL text, or one without letters, gets ``und`` with score 0, and so does every text if nothing could be
learned; languages that score alike are taken in alphabetical order; a NULL identifier counts as empty text; rows that repeat
an identifier are judged, and learned from, one by one; an empty table gives an empty result; other columns are not read.
Memory is bounded by the matrix and the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.shipping import ship
from keysweep.llm.staging import Stage
from keysweep.llm.text import batch_of, map_pieces, mixed, pieces

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
# Languages of one matrix, which takes 128 KB for each of them.
MOST_LANGUAGES = 256
UNKNOWN = "und"
# What turns up to three code points into one number before it is mixed.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_buckets(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of each n-gram, in the order of texts, and whether each text has letters."""
    lowered = [(t or "").lower() for t in texts]
    joined = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    # The character after each text is a mark, too, so every text ends in one.
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    is_letter = letters()[joined]
    codes = np.where(is_letter, joined, 0).astype(np.uint64)
    starts = np.zeros(len(joined), bool)
    starts[ends[:-1]] = True
    starts[:1] = True
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep |= starts
    own = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    codes, own = codes[keep], own[keep]
    found, whose = [], []
    for n in ORDERS:
        size = max(len(codes) - n + 1, 0)
        total = np.full(size, n, np.uint64)
        for k in range(n):
            total = total + codes[k : k + size] * np.uint64(FACTORS[k])
        inside = own[:size] == own[n - 1 : n - 1 + size]
        if n == 1:
            inside = inside & (codes[:size] > 0)
        found.append((mixed(total[inside]) % np.uint64(buckets)).astype(np.int64))
        whose.append(own[:size][inside])
    has = np.bincount(own, codes > 0, len(ends)) > 0
    return np.concatenate(found), np.concatenate(whose), has


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(column(id_col).cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, n): sums over all rows of (text, lang); the bucket -1 counts documents."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                bucket, text, has = gram_buckets(piece.column("text").to_pylist(), buckets)
                names = piece.column("lang").to_pylist()
                known = sorted(set(names))
                lang = np.array([known.index(x) for x in names])
                for i, name in enumerate(known):
                    own = sums.setdefault(name, np.zeros(buckets + 1, np.int64))
                    own[:-1] += np.bincount(bucket[lang[text] == i], minlength=buckets)
                    own[-1] += int((has & (lang == i)).sum())
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield batch_of(lang=pa.array([name] * len(at), pa.string()), bucket=np.where(at == buckets, -1, at), n=own[at])

    ship(docs.sparkSession)
    found = docs.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Some languages in alphabetical order, and their matrix of log-probabilities, one row for each bucket.

    ``documents`` has the number of documents of each of these languages, ``total`` that of all languages.
    """

    def __init__(self, documents: dict[str, int], total: int, rows, buckets: int, smoothing: float):
        self.languages, self.buckets = sorted(documents), buckets
        place = {lang: i for i, lang in enumerate(self.languages)}
        counts = np.full((buckets, len(place)), smoothing)
        for row in rows:
            counts[row.bucket, place[row.lang]] += row.n
        self.matrix = np.log(counts / counts.sum(axis=0)).astype(np.float32) if len(place) else counts
        self.share = np.log(np.array([documents[lang] for lang in self.languages]) / max(total, 1))

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text and language, and whether each text has letters."""
        bucket, text, has = gram_buckets(texts, self.buckets)
        total = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(text, self.matrix[:, k][bucket], len(texts)) + self.share[k]
        return total, has

    def best(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The best language of each text, its log-probability, and the sum of the chances of all languages over its own."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.inf)
        total, has = self.scores(texts)
        best, top = total.argmax(axis=1), total.max(axis=1)
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
        return names, top, np.where(has, np.exp(total - top[:, None]).sum(axis=1), np.inf)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, _, others = self.best(texts)
        return names, 1 / others


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    most_languages: int = MOST_LANGUAGES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score."""
    stage, context = Stage(docs.sparkSession, "language-id"), docs.sparkSession.sparkContext
    known = docs.filter(column(text_col).isNotNull() & column(lang_col).isNotNull() & ~held_out(id_col))
    known = known.select(column(text_col).alias("text"), column(lang_col).cast("string").alias("lang"))
    counts = stage(train(known, buckets), "counts")
    # One number for each language that has a document with letters.
    documents = {r.lang: r.n for r in counts.filter("bucket = -1").collect()}
    total, names = sum(documents.values()), sorted(documents)
    rows = docs.select(
        column(id_col).cast("bigint").alias("id"),
        held_out(id_col).alias("held_out"),
        F.xxhash64(column(text_col)).alias("digest"),
        column(text_col).alias("text"),
    )

    def model(own: list[str]) -> Model:
        sums = counts.filter((F.col("bucket") >= 0) & F.col("lang").isin(own)).toLocalIterator() if own else ()
        return Model({lang: documents[lang] for lang in own}, total, sums, buckets, smoothing)

    if len(names) <= most_languages:
        return scored(rows, context.broadcast(model(names)))
    parts = None
    for k in range(0, len(names), most_languages):
        shared = context.broadcast(model(names[k : k + most_languages]))
        part = stage(candidates(rows, shared).withColumn("matrix", F.lit(k)), f"part-{k}")
        shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    return united(parts)


def scored(rows: DataFrame, shared) -> DataFrame:
    def predict(piece: pa.RecordBatch) -> pa.RecordBatch:
        names, chance = shared.value.predict(piece.column("text").to_pylist())
        return batch_of(doc_id=piece.column("id"), held_out=piece.column("held_out"), lang_pred=pa.array(names, pa.string()), score=chance)

    return map_pieces(rows, ["id", "held_out", "text"], predict, "doc_id long, held_out boolean, lang_pred string, score double")


def candidates(rows: DataFrame, shared) -> DataFrame:
    """The best of some languages for each row, its log-probability, and the sum of the chances of these languages over its own."""

    def find(piece: pa.RecordBatch) -> pa.RecordBatch:
        names, top, others = shared.value.best(piece.column("text").to_pylist())
        columns = {name: piece.column(name) for name in ("id", "held_out", "digest")}
        return batch_of(**columns, lang=names, top=top, others=others)

    schema = "id long, held_out boolean, digest long, lang string, top double, others double"
    return map_pieces(rows, ["id", "held_out", "digest", "text"], find, schema)


def united(parts: DataFrame) -> DataFrame:
    """Results of several matrices, each with its number. Rows of one identifier and text are alike, and judged once."""
    row = ["id", "held_out", "digest"]
    each = parts.groupBy(*row, "matrix").agg(*[F.first(c).alias(c) for c in ("lang", "top", "others")], F.count("*").alias("rows"))
    found = each.groupBy(*row).agg(
        F.min_by("lang", F.struct((-F.col("top")).alias("top"), "lang")).alias("lang_pred"),
        F.max("top").alias("most"),
        F.collect_list(F.struct("top", "others")).alias("all"),
        F.first("rows").cast("int").alias("rows"),
    )
    chances = F.aggregate("all", F.lit(0.0), lambda acc, x: acc + x["others"] * F.exp(x["top"] - F.col("most")))
    copied = found.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("rows"))))
    return copied.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", (1 / chances).alias("score"))
