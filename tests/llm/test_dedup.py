"""Substring dedup, SimHash near-dedup, line dedup: against plain versions, and odd tables."""

from __future__ import annotations

import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from keysweep.llm import line_dedup as ld
from keysweep.llm import simhash as sh
from keysweep.llm import substring_dedup as sd
from keysweep.llm.components import components
from keysweep.llm.staging import Stage
from keysweep.llm.text import powers, range_hashes


def by_id(df, name):
    return {r.doc_id: r[name] for r in df.collect()}


@pytest.mark.parametrize(("length", "seed_words"), [(20, 6), (7, 3), (5, 5), (4, 1)])
def test_substring(frame, corpus, length, seed_words):
    found = sd.substring_dedup(frame(corpus), length=length, seed_words=seed_words).collect()
    want = brute.substring(corpus, length)
    assert {r.doc_id: r.kept for r in found} == {i: " ".join(w) for i, w in want.items()}
    assert {r.doc_id: r.n_removed for r in found} == {i: len(brute.words(t)) - len(want[i]) for i, t in corpus}


def test_substring_of_odd_rows(frame):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (4, text), (4, text), (5, text), (None, "x " + text), (5, "another text")]
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed) for r in sd.substring_dedup(frame(rows)).collect())
    # The text without an identifier is the earliest; repeated rows do not remove each other.
    assert found == [(False, 0, 31, 0), (True, 1, 0, 0), (True, 2, 0, 0), (True, 4, 30, 30), (True, 4, 30, 30), (True, 5, 2, 0), (True, 5, 30, 30)]
    again = sd.substring_dedup(frame(rows[2:4])).collect()
    assert [r.n_removed for r in again] == [0, 0]
    assert sd.substring_dedup(frame([])).count() == 0


def equal_crc(n, mark):
    """``n`` different words that begin with ``mark``, so written that texts of either mark have one CRC-32."""
    bits = ("plumless", "buckeroo")
    return [mark + "".join(bits[k >> b & 1] for b in range(5)) for k in range(n)]


def test_texts_of_one_identifier_and_crc_are_told_apart(frame):
    one, other = (" ".join(equal_crc(26, mark)) for mark in ("plumless", "buckeroo"))
    assert one != other and zlib.crc32(one.encode()) == zlib.crc32(other.encode())
    for i in (5, None):
        rows = [(0, one), (i, one), (i, other)] if i else [(None, other), (None, one), (1, one)]
        key = lambda r: -1 if r.doc_id is None else r.doc_id
        found = sorted((key(r), r.n_removed) for r in sd.substring_dedup(frame(rows)).collect())
        assert found == ([(0, 0), (5, 0), (5, 26)] if i else [(-1, 0), (-1, 0), (1, 26)])
        lines = sorted((key(r), r.text) for r in ld.line_dedup(frame(rows)).collect())
        assert lines == (sorted([(0, one), (5, ""), (5, other)]) if i else sorted([(-1, one), (-1, other), (1, "")]))


def test_leftmost_least():
    rng = np.random.default_rng(0)
    for width in (1, 2, 3, 5, 8, 13, 15):
        x = rng.integers(0, 6, 60)
        want = [i + int(np.argmin(x[i : i + width])) for i in range(60 - width + 1)]
        assert sd.leftmost_least(x, width).tolist() == want


def test_hash_depends_on_words_alone():
    words = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    h = range_hashes(words, np.array([0, 3, 4]), np.array([3, 3, 3]))
    assert h[0] == h[1] != h[2]
    up, down = powers(0x9E3779B97F4A7C15, 100)
    assert ((up * down) == 1).all()


@pytest.mark.parametrize(("shingle", "bits"), [(3, 3), (2, 6), (1, 0)])
def test_simhash(frame, corpus, shingle, bits):
    prints = {i: brute.fingerprint(t, shingle) for i, t in corpus}
    found = sh.simhash_components(frame(corpus), shingle=shingle, max_bits=bits)
    rows = found.collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute.linked(prints, bits)


def test_simhash_of_odd_rows(frame):
    rows = [(3, "a b c d"), (3, "a b c d"), (3, "quite another text"), (5, "a b c d"), (None, "only here it is"), (None, None), (7, ""), (8, " ")]
    kept = sh.simhash_dedup(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "only here it is"), (3, "a b c d"), (3, "quite another text"), (7, "")]
    assert sh.simhash_dedup(frame([])).count() == 0


@pytest.mark.parametrize("parts", [[sh.Part(tuple(range(32)), 1), sh.Part(tuple(range(32, 64)), 1)], [sh.Part(tuple(range(64)), 3)][:1]])
def test_links_of_unequal_thresholds(spark, parts):
    if len(parts) == 1:
        parts = [sh.Part(tuple(range(0, 20)), 2), sh.Part(tuple(range(20, 40)), 0), sh.Part(tuple(range(40, 64)), -1)][:2]
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), False)) for b in base for _ in range(6)]
    prints = sorted(set(near))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    got = {frozenset((r.a & (2**64 - 1), r.b & (2**64 - 1))) for r in sh.links(df, parts, 3).collect()}
    want = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    assert got == want


def test_thresholds_add_up():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64)).astype(float)
    for total in (10, 10_000, 10**9, 10**12):
        for most in (0, 1, 3, 7):
            parts = sh.plan_parts(total, bits.T @ bits * (total / 500), most)
            # Parts that are left out count with -1.
            groups = next(m for m in range(1, sh.MOST_PARTS + 1) if any(set(p.bits) == set(g) for p in parts for g in sh.grouped(np.abs(np.corrcoef(bits.T)) * (1 - np.eye(64)), m)) or m == sh.MOST_PARTS)
            assert parts and all(0 <= p.threshold <= most for p in parts) and groups


def test_components_of_a_path(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(60) if i != 30], "a long, b long")
    found = {r.node: r.root for r in components(df, Stage(spark, "t")).collect()}
    assert found == {**{i: 0 for i in range(1, 31)}, **{i: 31 for i in range(32, 61)}}


@pytest.mark.parametrize("least", [8, 4])
def test_lines(frame, corpus, least):
    got = by_id(ld.line_dedup(frame(corpus), min_words=least), "text")
    assert {i: t or "" for i, t in got.items()} == brute.lines(corpus, least)


def test_line_forms(frame):
    line = [f"w{i}" for i in range(16)]
    forms = [line, line[:5] + line[6:], line[:9] + ["x"] + line[10:], [*line, "y"], ["z", *line[1:]], line[:4] + ["q"] + line[4:], ["a", "b", *line[2:]], line[1:15]]
    rows = [(i, "  ".join(f)) for i, f in enumerate(forms)] + [(20, "one two"), (21, "one three"), (22, "one two")]
    assert by_id(ld.line_dedup(frame(rows)), "text") == brute.lines(rows, 8)


def test_lines_of_odd_rows(frame):
    rows = [(1, None), (2, "\n\n"), (3, "a b\nc"), (3, "a b\nc"), (4, "c\r\na  b"), (None, "c")]
    out = ld.line_dedup(frame(rows), count_col="gone")
    assert out.columns == [*frame(rows).columns, "gone"]
    got = sorted((r.doc_id or 0, r.text, r.gone) for r in out.fillna("-", ["text"]).collect())
    assert got == [(0, "c", 0), (1, "-", 0), (2, "\n\n", 0), (3, "a b", 1), (3, "a b", 1), (4, "", 2)]
    # A text without words was not emptied by the removal.
    assert ld.line_dedup(frame(rows), emptied=False).filter(F.col("doc_id") == 4).count() == 0
    assert ld.line_dedup(frame(rows), emptied=False).count() == 5
    assert ld.line_dedup(frame([])).count() == 0


@pytest.mark.parametrize("rate", [3, 10])
def test_lines_with_a_growing_bound(frame, corpus, rate):
    rng = np.random.default_rng(rate)
    base = [f"v{i}" for i in range(57)]
    forms = [base, base[:20] + ["a", "b"] + base[21:], [*base[:9], "x", *base[10:40], "y", *base[41:]], base[3:], ["z"] * 9 + base[9:]]
    rows = [(500 + i, " ".join(f)) for i, f in enumerate(forms)] + [(600, "one two three four"), (601, "one two three 4"), (602, "one two 3 4")]
    # Lines of all lengths with random edits, about as many as allowed.
    for n in (3, 5, 6, 9, 20, 31):
        line = [f"l{n}-{k % 7}" for k in range(n)]
        for e in range(4):
            other = list(line)
            for at in rng.integers(0, n, e * (n // rate + 1) // 2):
                other[at % len(other) : at % len(other) + rng.integers(0, 2)] = ["n"] * rng.integers(0, 2)
            rows.append((700 + 10 * n + e, " ".join(other)))
    rows = corpus + rows
    seen, want = [], {}
    for i, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            w = brute.words(line)
            allowed = [(o, max(min(len(w), len(o)) // rate, min(len(w), len(o)) >= 8)) for o in seen]
            if not w or not any(abs(len(w) - len(o)) <= k and brute.distance(w, o) <= k for o, k in allowed):
                kept.append(line)
            if w:
                seen.append(w)
        want[i] = "\n".join(kept)
    assert by_id(ld.line_dedup(frame(rows), words_per_edit=rate), "text") == want
    assert want != brute.lines(rows, 8)
