"""Secret scans with built-in functions only: fixed patterns, and the entropy of sliding windows over candidate strings.

Patterns, each leftmost and non-overlapping, with a least length below which a match is dropped: assignments to names like
``password``, access keys, and runs of hex digits. Places are in code points, ends exclusive.

Candidates are runs of at least ``WINDOW`` letters, digits and ``+/_=-``, unless the allow-list knows their form: plain words, words
joined by marks, numbers and dates, runs of one character. A window of ``WINDOW`` characters slides over each
candidate, and the counts of its characters are changed by the one that enters and the one that leaves. Its entropy is held
against the threshold of the candidate's character class: hex digits, letters, letters and digits, or any. Windows at or above it
form spans where they overlap. What matches of patterns cover of a span is taken out of it, and
the parts that are left are kept.

Sums of counts times logarithms are kept as integers, so that they do not depend on the order of changes. The windows of a candidate
are taken ``SEGMENT`` at a time, so that the work grows with its length and no faster.

Cases: a NULL text counts as empty, and has no matches; texts, matches and candidates may have any length that a string
has, and patterns do not recurse with it; rows that repeat an identifier are scanned one by one; an empty table
gives an empty result; other columns are not read. Everything about a text stays in its row: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column

WINDOW = 20
# Integers that stand for one bit of the sum of counts times their logarithms.
SCALE = 1 << 32
# Numbers of running totals that are added up at a time, and windows whose counts are carried on.
BLOCK = 256
SEGMENT = 256


@dataclass(frozen=True)
class Kind:
    """A pattern without capturing groups but one, whose least length is checked; group 0 is the whole match."""

    name: str
    pattern: str
    group: int
    least: int


# The patterns, in the order of their names in results.
KINDS = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18),
    Kind("hex", r"[0-9a-f]+", 0, 16),
)
ENTROPY = "entropy"
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Classes of candidates, the first that fits: pattern, characters, and least entropy in bits of a window.
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", "0123456789abcdefABCDEF", 3.1),
    ("letters", r"^[A-Za-z]+$", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.8),
    ("alphanumeric", r"^[0-9A-Za-z]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.7),
    ("any", r"", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.8),
)
# Words: of one case, capitalised, or in camel case with parts of three letters at least after the first, or two before such a part.
WORDS = r"(?:[A-Z]+|[A-Z]?[a-z]+)(?:[A-Z][a-z]{2,}|[A-Z][a-z](?=[A-Z][a-z]{2}))*+"
# A word or number between marks; it must end at a mark, so that no other way to read it is ever tried. Repetitions of it
# are possessive, which Java's patterns run in a loop, not by recursion.
PART = rf"(?:{WORDS}|[0-9]{{1,8}})(?=[+/_=-]|$)"
# Forms that are no secrets: words, words joined by marks, numbers and dates, runs of one character.
ALLOWED = rf"^(?:{WORDS}|[+/_=-]*{PART}(?:[+/_=-]+{PART})*+[+/_=-]*|[0-9+/_=-]+|(.)\1*+)$"


def pieces(text: Column, pattern: str) -> Column:
    """The text up to the end of each match, from the end of the one before. Most texts have none, which a plain search
    finds out several times as fast."""
    found = F.regexp_extract_all(text, F.lit(rf"\G[\s\S]*?(?:{pattern})"), F.lit(0))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<string>"))


def running_totals(lengths: Column) -> Column:
    """Sum of ``lengths`` up to each one, by blocks, so that long arrays are not copied for each element."""

    def totals(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<int>")
        return F.aggregate(
            values,
            F.struct(start.alias("sum"), empty.alias("out")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"] + x)).alias("out")),
            lambda acc: acc["out"],
        )

    count = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x))
    before = totals(sums, F.lit(0))
    whole = F.flatten(F.transform(blocks, lambda block, i: totals(block, F.when(i == 0, 0).otherwise(F.get(before, i - 1)))))
    return F.when(count == 0, F.array().cast("array<int>")).when(count <= BLOCK, totals(lengths, F.lit(0))).otherwise(whole)


def placed(parts: Column, ends: Column, pattern: str, group: int, least: int) -> Column:
    """The matches at the end of ``parts`` whose group is long enough: start, end and the match itself."""
    anchored = rf"^[\s\S]*?({pattern})$"

    def match(part: Column, end: Column) -> Column:
        found = F.regexp_extract(part, anchored, 1)
        checked = F.regexp_extract(part, anchored, 1 + group)
        return F.struct(
            (end - F.char_length(found)).alias("start"), end.alias("end"), found.alias("found"), F.char_length(checked).alias("size")
        )

    return F.filter(F.zip_with(parts, ends, match), lambda m: m["size"] >= least)


def scaled(count: int) -> int:
    return round(count * log2(count) * SCALE) if count else 0


def highest_sum(entropy: float) -> int:
    """The largest sum of counts times logarithms that a window of this entropy has."""
    return floor(WINDOW * (log2(WINDOW) - entropy) * SCALE)


# A character that does not count, in the numbers of characters that enter and leave windows.
NONE = 1000


def bound(value: Column, use) -> Column:
    """``use`` of an array that is made once, however often ``use`` looks at it."""
    return F.flatten(F.transform(F.array(value), use))


def good_windows(places: Column, block: Column, characters: str, entropy: float) -> Column:
    """Starts of the windows of one segment that have at least ``entropy`` bits, by counts that change by a character at a time."""
    logs = F.array(*[F.lit(scaled(c)).cast("bigint") for c in range(WINDOW + 2)])
    low = block * SEGMENT
    own = F.slice(places, low + 1, SEGMENT + WINDOW - 1)
    # Each character takes three steps: the one before the window leaves, it enters, and the sum is looked at.
    left = lambda i: F.when(i >= WINDOW, -F.get(places, low + i - WINDOW)).otherwise(NONE)
    steps = F.flatten(F.transform(own, lambda place, i: F.array(left(i), place, F.lit(0))))
    first = F.struct(
        F.array_repeat(F.lit(0), len(characters)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        F.lit(0).alias("taken"),
        F.array().cast("array<int>").alias("good"),
    )

    def changed(acc: Column, place: Column, by: int) -> Column:
        was = F.get(acc["counts"], place - 1)
        counts = F.transform(acc["counts"], lambda c, k: F.when(k == place - 1, c + by).otherwise(c))
        total = acc["sum"] - F.get(logs, was) + F.get(logs, was + by)
        return F.struct(counts.alias("counts"), total.alias("sum"), acc["taken"].alias("taken"), acc["good"].alias("good"))

    def noted(acc: Column) -> Column:
        start = (low + acc["taken"] + 1 - WINDOW).cast("int")
        good = (acc["taken"] + 1 >= WINDOW) & (acc["sum"] <= highest_sum(entropy))
        starts = F.when(good, F.concat(acc["good"], F.array(start))).otherwise(acc["good"])
        return F.struct(acc["counts"].alias("counts"), acc["sum"].alias("sum"), (acc["taken"] + 1).alias("taken"), starts.alias("good"))

    def step(acc: Column, place: Column) -> Column:
        return F.when(place == 0, noted(acc)).when(place == NONE, acc).when(place > 0, changed(acc, place, 1)).otherwise(changed(acc, -place, -1))

    return F.aggregate(steps, first, step, lambda acc: acc["good"])


def entropy_spans(found: Column, start: Column, characters: str, entropy: float) -> Column:
    """Spans of overlapping windows of at least ``entropy`` bits."""

    def of_places(places: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(places) - WINDOW) / SEGMENT).cast("int"))
        return bound(F.flatten(F.transform(blocks, lambda b: good_windows(places, b, characters, entropy))), of_starts)

    def of_starts(good: Column) -> Column:
        lows = F.filter(good, lambda x, i: (i == 0) | (x > F.get(good, i - 1) + WINDOW))
        highs = F.filter(good, lambda x, i: (i == F.size(good) - 1) | (F.get(good, i + 1) > x + WINDOW))
        span = lambda a, b: F.struct((start + a).cast("int").alias("start"), (start + b + WINDOW).cast("int").alias("end"))
        return F.zip_with(lows, highs, span)

    return bound(F.transform(F.split(found, ""), lambda c: F.instr(F.lit(characters), c)), of_places)


def outside(span: Column, known: Column) -> Column:
    """The parts of a span that no match in ``known``, sorted by start, covers."""
    part = "array<struct<start:int,end:int>>"

    def cut(acc: Column, k: Column) -> Column:
        more = F.concat(acc["parts"], F.array(F.struct(acc["at"].alias("start"), k["start"].alias("end"))))
        parts = F.when(k["start"] > acc["at"], more).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], k["end"]).alias("at"), parts.alias("parts"))

    def last(acc: Column) -> Column:
        rest = F.array(F.struct(acc["at"].alias("start"), span["end"].alias("end")))
        return F.when(acc["at"] < span["end"], F.concat(acc["parts"], rest)).otherwise(acc["parts"])

    met = F.filter(known, lambda k: (k["start"] < span["end"]) & (span["start"] < k["end"]))
    return F.aggregate(met, F.struct(span["start"].alias("at"), F.array().cast(part).alias("parts")), cut, last)


def listed(name: str, spans: Column) -> Column:
    """Spans as structs that sort by start and then by kind."""
    order = [k.name for k in KINDS].index(name) if name != ENTROPY else len(KINDS)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(name).alias("kind"))
    )


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, and arrays of structs (start, end) named after the kinds, and ``entropy``."""
    rows = docs.select(column(id_col).cast("bigint").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    parts = {k.name: pieces(F.col("text"), k.pattern) for k in KINDS}
    # Runs of hex digits are everywhere; those too short to keep are never parts of longer ones.
    parts["hex"] = pieces(F.col("text"), rf"(?<![0-9a-f])[0-9a-f]{{{KINDS[2].least},}}")
    rows = rows.select("doc_id", *[p.alias(f"p_{n}") for n, p in parts.items()], pieces(F.col("text"), CANDIDATE).alias("p_entropy"))
    names = [*(k.name for k in KINDS), ENTROPY]
    ends = {n: running_totals(F.transform(F.col(f"p_{n}"), lambda p: F.char_length(p))) for n in names}
    rows = rows.select("doc_id", *[f"p_{n}" for n in names], *[ends[n].alias(f"e_{n}") for n in names])
    matches = {k.name: placed(F.col(f"p_{k.name}"), F.col(f"e_{k.name}"), k.pattern, k.group, k.least) for k in KINDS}
    matches["hex"] = placed(F.col("p_hex"), F.col("e_hex"), rf"(?<![0-9a-f])[0-9a-f]{{{KINDS[2].least},}}", 0, KINDS[2].least)
    candidates = placed(F.col("p_entropy"), F.col("e_entropy"), CANDIDATE, 0, WINDOW)
    rows = rows.select(
        "doc_id",
        *[F.transform(m, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(n) for n, m in matches.items()],
        F.filter(candidates, lambda c: ~c["found"].rlike(ALLOWED)).alias("candidates"),
    )

    def of_class(c: Column) -> Column:
        out = None
        for _, pattern, characters, entropy in reversed(CLASSES):
            own = entropy_spans(c["found"], c["start"], characters, entropy)
            out = own if out is None else F.when(c["found"].rlike(pattern), own).otherwise(out)
        return out

    found = F.flatten(F.transform(F.col("candidates"), of_class))
    known = F.array_sort(F.concat(*[F.col(k.name) for k in KINDS]))
    alone = F.flatten(F.transform(found, lambda s: outside(s, known)))
    return rows.select("doc_id", *[k.name for k in KINDS], alone.alias(ENTROPY))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of the matches of each pattern, a checksum of their places, and all spans."""
    base = F.concat(*[listed(k.name, F.col(k.name)) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(k.name).cast("bigint").alias(f"n_{k.name}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, listed(ENTROPY, F.col(ENTROPY)))).alias("spans"),
    )
