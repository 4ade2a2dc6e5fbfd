"""Plain versions of the operators, over lists of (identifier, text)."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring(rows, length):
    """Kept words of rows with different identifiers."""
    first = {}
    for i, text in sorted(rows):
        w = words(text)
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (i, s))
    out = {}
    for i, text in rows:
        w = words(text)
        gone = {p for s in range(len(w) - length + 1) if first[tuple(w[s : s + length])] < (i, s) for p in range(s, s + length)}
        out[i] = [x for p, x in enumerate(w) if p not in gone]
    return out


def fingerprint(text, shingle):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fingerprints, most):
    """Least identifier reachable from each of {identifier: fingerprint}."""
    root = {i: i for i in fingerprints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fingerprints)
    for a in ids:
        for b in ids:
            if a < b and (fingerprints[a] ^ fingerprints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def distance(a, b):
    """Edit distance of word lists."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines(rows, least):
    """Text that stays of rows with different identifiers."""
    seen, out = [], {}
    for i, text in sorted(rows):
        kept = []
        for line in (text or "").split("\n"):
            w = words(line)
            close = lambda o: w == o or (min(len(w), len(o)) >= least and abs(len(w) - len(o)) < 2 and distance(w, o) <= 1)
            if not w or not any(close(o) for o in seen):
                kept.append(line)
            if w:
                seen.append(w)
        out[i] = "\n".join(kept)
    return out


def quality_counts(text):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeat = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for p in range(i, i + 3)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(repeat)


def contamination(rows, items, size):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for i, text in items:
        w = split(text)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + size]), set()).add(str(i))
    out = {}
    for i, text in rows:
        w, hit, found = split(text), set(), set()
        for win, ids in windows.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= ids
        out[i] = (len(w), sorted(hit), sorted(found))
    return out
