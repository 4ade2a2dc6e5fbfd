"""License scans, Merkle manifests and conversation repair, against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keysweep.llm import conversation, license_scan, merkle
from keysweep.llm.decontaminate import tokens
from keysweep.llm.license_scan import BASE, TEMPLATES, license_digest
from keysweep.llm.ranks import placed, with_ranks
from keysweep.llm.staging import Stage

SCHEMA = "doc_id long, source string, lang string, n_chars string, text string"
CLASHES = "hash string, item string, grp int, rank long, place long, task long, conv long, block long, fault int, words int, id long, label string, start long"
LOWER = {c: c + 32 for c in range(65, 91)}


def crc(text):
    return zlib.crc32(text.encode())


def clashing(spark, rows, schema):
    names = [c.split()[0] for c in CLASHES.split(", ")]
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], f"{schema}, {CLASHES}")


# Ranks ---------------------------------------------------------------------------------------------


def test_ranks_of_a_hot_group_come_from_many_tasks(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("g"), (F.col("id") * 37 % 6000).alias("v"))
    # Few rows would be brought together to one task again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        whole = with_ranks(placed(Stage(spark, "ranks"), rows, ["g", "v"], "rows"), "g")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert whole.filter("g = 7").select(F.shiftright("place", 33)).distinct().count() > 1
    by = {}
    for r in whole.collect():
        by.setdefault(r.g, []).append((r["rank"], r.v, r.total))
    for found in by.values():
        found.sort()
        assert [r for r, _, _ in found] == list(range(len(found)))
        assert [v for _, v, _ in found] == sorted(v for _, v, _ in found)
        assert {t for _, _, t in found} == {len(found)}


# Merkle manifests ----------------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The top of nodes, and for each of them its siblings before and after it, level by level."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + 16, len(nodes))) for k in range(0, len(nodes), 16)]
        for run in runs:
            for j in run:
                for i in under[j]:
                    paths[i].append(("".join(nodes[run[0] : j]), "".join(nodes[j + 1 : run[-1] + 1])))
        nodes, under = [digest(*(nodes[j] for j in run)) for run in runs], [sum((under[j] for j in run), []) for run in runs]
    return nodes[0], paths


def manifest(rows):
    written = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for row in rows:
        leaf = changed = digest(*map(written, row))
        if row[0] is not None and crc(str(row[0])) % 5 == 0:
            changed = digest(*map(written, row[:4]), written(row[4] and row[4].translate(LOWER)))
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf, changed, row[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = [tree([x[2] for x in sorted(groups[s])]) for s in names]
    root, above = tree([top for top, _ in tops])
    out = []
    for s, (top, paths), upper in zip(names, tops, above):
        for (_, _, leaf, changed, i), path in zip(sorted(groups[s]), paths):
            folded = changed
            for before, after in path + upper:
                folded = digest(before, folded, after)
            out.append((i, leaf, top, root, digest(*(b + a for b, a in path + upper)), folded, folded == root))
    return sorted(out, key=str)


ODD_ROWS = [
    (None, None, None, None, None), (None, None, None, None, None), (1, None, "", "", ""), (5, "b", "x", None, "AbC"),
    (5, "b", "x", None, "AbC"), (5, "b", "x", None, "AbD"), (7, "", "é", "1", "Ab\n" * 200_000), (8, "Z", None, "2", None),
]


@pytest.mark.parametrize("sizes", [(), (1,), (16, 17), (255, 256, 257), (700, 3, 4200)])
def test_manifest(spark, sizes):
    rows = ODD_ROWS + [(i, f"é{g}", "x", str(i), f"Text {i}") for g, n in enumerate(sizes) for i in range(n)]
    got = merkle.merkle_digest(clashing(spark, rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == manifest(rows)


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame(ODD_ROWS[3:4], SCHEMA)
    assert [tuple(r) for r in merkle.merkle_digest(one).collect()] == manifest(ODD_ROWS[3:4])
    assert merkle.merkle_digest(one.limit(0)).collect() == []


def test_manifest_of_many_groups(spark):
    rows = [(i, f"s{i % 300}", "x", "1", "T") for i in range(600)]
    assert sorted(map(tuple, merkle.merkle_digest(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == manifest(rows)


def test_proofs_verify_and_need_no_joins(spark):
    rows = [(i, f"s{i % 2}", "x", "1", f"T{i}") for i in range(900)]
    found = merkle.merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    assert found.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert found.filter(merkle.folded(merkle.digest(F.col("leaf")), F.col("path")) == F.col("root")).count() == 0
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


# License scans -------------------------------------------------------------------------------------


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def licences(rows, templates, indexed=license_scan.INDEXED, looked_up=license_scan.LOOKED_UP):
    """Labels and the greatest share of rows, by looking at every start of every template."""
    texts = [split(t) for _, t in rows]
    known = {w for t in templates for w in split(t.text)} | {w for t in templates for p in t.phrases for w in split(p)}
    known |= {w for p, _ in BASE for w in split(p)}
    frequency = {w: sum(w in set(t) for t in texts) for w in known}
    idf = {w: float(np.log((1 + len(rows)) / (1 + n))) for w, n in frequency.items()}
    out = []
    for (i, _), words in zip(rows, texts):
        places = lambda phrase: [s for s in range(len(words) - len(phrase) + 1) if words[s : s + len(phrase)] == phrase]
        base = sorted((s, label) for p, label in BASE for s in places(split(p)))
        labels, shares = {label for _, label in base}, [1.0] if base else []
        for t in templates:
            text = split(t.text)
            distinct = sorted(set(text), key=lambda w: (-idf[w], w))
            rare = distinct[: min(indexed, max(license_scan.VOTES, (len(distinct) + 1) // 2))]
            looked = set([w for w in rare if w in words][:looked_up])
            phrases = [places(split(p)) for p in t.phrases]
            for s in range(-len(text), len(words)):
                in_place = {w for j, w in enumerate(text) if w in looked and 0 <= s + j < len(words) and words[s + j] == w}
                low, high = max(s - license_scan.SLACK, 0), min(s + len(text) + license_scan.SLACK, len(words))
                whole = all(any(low <= p <= high - len(split(q)) for p in found) for q, found in zip(t.phrases, phrases))
                if len(in_place) >= license_scan.VOTES and whole:
                    labels.add(t.label)
                    shares.append(sum(0 <= s + j < len(words) and words[s + j] == w for j, w in enumerate(text)) / len(text))
        starts = [s for s, _ in base]
        row = (i, len(words), len(base), min(starts, default=None), max(starts, default=None))
        out.append((*row, ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), max(shares, default=0.0)))
    return sorted(out, key=str)


def licence_rows():
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choice(("lorem", "Ipsum,", "the", "license", "of", "version 2", "é")) for _ in range(n))
    rows = []
    for t in TEMPLATES:
        words = t.text.title().split()
        rows.append(" ".join((filler(rng.randint(0, 30)), *words, filler(rng.randint(0, 9)))))
        cut = rng.randint(0, len(words) // 2)
        rows.append(" ".join(words[cut:]))
        place = rng.randrange(len(words))
        rows.append(" ".join((*words[:place], "some other words", *words[place:], filler(5))))
    rows += [rows[0] + rows[12] + rows[21], "MIT-License mit license; Apache\nlicense GENERAL public LICENSE", "mit", "license mit"]
    rows += [None, "", " \n", "license " * 3000, filler(400), filler(400)]
    return [(i, t) for i, t in enumerate(rows)] + [(None, rows[3]), (5, rows[5])]


def scanned(df, templates=TEMPLATES):
    return sorted(map(tuple, license_digest(license_scan.license_scan(df, templates=templates)).collect()), key=str)


def test_licences(spark):
    rows = licence_rows()
    assert scanned(clashing(spark, [], "doc_id long, text string")) == []
    assert scanned(spark.createDataFrame(rows, "doc_id long, text string").withColumns({c.split()[0]: F.lit(None) for c in CLASHES.split(", ")})) == licences(rows, TEMPLATES)


def test_licences_of_given_documents(spark):
    from compare import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.filter("text ilike '%licen%'").collect()]
    got = {r[0]: r[5:] for r in scanned(docs)}
    # Frequencies are those of all documents, which may weigh words otherwise; the labels do not depend on it here.
    assert {i: got[i] for i, _ in rows} == {r[0]: r[5:] for r in licences(rows, TEMPLATES)}
    assert len(rows) > 30 and sum(bool(x[1]) for x in got.values()) == len([r for r in rows if got[r[0]][1]])


def test_long_texts_are_looked_up_in_stretches(monkeypatch):
    """The same matches, however few places are looked up at a time."""
    words = license_scan.Words(TEMPLATES, BASE)
    index = license_scan.Index(TEMPLATES, BASE, words, np.zeros(len(words.words), np.int64), 0)
    _, starts, ends, hashes, firsts = tokens(pa.array([t or "" for _, t in licence_rows()]))
    numbers = words.numbers(hashes, ends - starts)
    whole = index.matches(numbers, firsts)
    for chunk in (1, 7, 100):
        monkeypatch.setattr(license_scan, "CHUNK", chunk)
        assert index.matches(numbers, firsts) == whole
    assert len(whole) > 50


# Conversations -------------------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def repaired(rows):
    """Counts, cost, audit and repaired rows of one conversation, by a program from the start over whole audits."""
    seen, faults, out = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            out[fault] += 1
    pairs = zip(rows, rows[1:])
    illegal = sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in pairs)
    after = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}

    def better(best, state, path):
        if state not in best or path[:2] < best[state][:2]:
            best[state] = path

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, kept) in list(best.items()):
                to, name = after[state]
                better(best, to, (cost + 3, audit + "I", kept + ((name, ""),)))
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        now = {}
        for state, (cost, audit, kept) in inserted(best).items():
            better(now, state, (cost + 4, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + 3 * (fault == "truncated")
            if (state, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                better(now, role[:1], (more, audit + "K", kept + ((role, text),)))
            to, name = after[state]
            better(now, to, (more + 3, audit + "R", kept + ((name, text),)))
        best = now
    cost, audit, kept = min(path for state, path in inserted(best).items() if state in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *out.values(), illegal, cost, audit), kept


def damaged(rows):
    by = {}
    for conv, turn, role, text in rows:
        found = by.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for found in by.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return by


def expected(rows):
    out = []
    for conv, found in damaged(rows).items():
        report, kept = repaired(found) if found else ((0, 0, 0, 0, 0, 0, ""), ())
        out.append((conv, *report, digest("\n".join(f"{r}:{t}" for r, t in kept))))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(1)
    roles = ("user", "assistant", "user", "assistant", "system", None, "tool", "", "u", "Assistant")
    texts = (None, "", " \n", "Yes.", "no", "Hm! ", "What?\n", "aé.", "b", "c.", "\x85.", " ")
    rows = []
    for conv in [None, *range(50)]:
        for i in range(700 if conv == 7 else rng.choice((1, 1, 2, 3, 5, 8, 20, 60))):
            rows.append((conv, rng.choice((None, i, i, i, i + rng.randint(0, 3))), rng.choice(roles), rng.choice((*texts, f"g {i}", f"{i}."))))
    return rows + rows[:30] + [(99, 1, "user", "long " * 200_000 + "."), (99, 2, "assistant", "x" * 1_000_000)]


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bits", [conversation.BLOCK_BITS, 2, 1])
def test_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation, "BLOCK_BITS", bits)
    monkeypatch.setattr(conversation, "BLOCK", 1 << bits)
    rows = conversations()
    turns = clashing(spark, rows, TURNS)
    found = conversation.repair_digest(turns)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(conversation, "BLOCK_BITS", 3)
    monkeypatch.setattr(conversation, "BLOCK", 8)
    rows = conversations()
    turns, edits, _ = conversation.repair(conversation.damaged(spark.createDataFrame(rows, TURNS)))
    got = {}
    for r in sorted(conversation.repaired_turns(turns, edits).collect(), key=lambda r: (str(r.conv), r.block, r.number)):
        got.setdefault(r.conv, []).append((r.role, r.text))
    want = {conv: list(repaired(found)[1]) for conv, found in damaged(rows).items() if found}
    assert got == {conv: kept for conv, kept in want.items() if kept}


def test_repair_of_an_empty_table(spark):
    assert conversation.repair_digest(spark.createDataFrame([], TURNS)).collect() == []
    # Every row of these is dropped.
    lost = [(c, 0, "user", "Yes.") for c in range(400) if crc(f"{c}:0") % 20 == 0]
    assert len(lost) > 5
    assert sorted(map(tuple, conversation.repair_digest(spark.createDataFrame(lost, TURNS)).collect()), key=str) == expected(lost)


def test_ranks_over_doubled_lengths_order_whole_audits():
    rng = random.Random(4)
    lists = [[rng.choice((0, 1, 2, 3)) + 4 * rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    codes, sizes = conversation.padded(lists)
    cost = conversation.costs(codes, sizes, np.array([conversation.FINAL] * len(lists)))
    letter, pointer = conversation.least_arcs(codes, sizes, cost)
    rank, pointers = conversation.doubled(letter, pointer, 3 * codes.shape[1] + 1)
    audits = []
    for node in range(len(letter)):
        audit = ""
        while letter[node]:
            audit += conversation.LETTERS[letter[node] - 1]
            node = pointer[node]
        audits.append(audit)
    distinct = sorted(set(audits))
    assert rank.tolist() == [distinct.index(a) for a in audits]
    assert all((letter[p] == 0).all() for p in pointers[-1:])
