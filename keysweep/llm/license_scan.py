"""License scans: a positional index of the rare words of licence texts, looked up with each file's rarest licence words.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z in lower case. The words of the templates are
weighed by their inverse document frequency, counted over all documents. The index holds, for each template, the positions
of the rarest half of its words, ``INDEXED`` at most. A file looks up its ``LOOKED_UP`` rarest indexed words of each template:
every place of such a word, less a position of the word in the template, is where the template would start. Starts on which two
or more words agree are candidates; a candidate is a match if all key phrases of the template stand, word for word, within
the words it covers, give or take ``SLACK``. Its share is the share of the template's words that stand in their places.

Base phrases are found apart from that, wherever their words are consecutive.

The first pass sends a count for each word of the templates and piece of text, summed in Spark to one row a word; the second
one scans. Neither shuffles texts, and the index is no larger than the templates. Candidates are made for bounded
stretches of the text at a time, so that a text of licence words alone needs no more memory for them.

Cases: a NULL text counts as empty, and an empty text has no words, no labels and a score of 0; templates with equal shares are told
apart by where they start; rows that repeat an identifier are scanned one by one, and repeated texts count each time in the
frequencies; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.decontaminate import tokens
from keysweep.llm.text import BYTE_BASE, batch_of, flat, map_pieces, ranges, span_hashes

# Most words of a template that are indexed, and that a file looks up.
INDEXED = 12
LOOKED_UP = 8
# Words that must agree on where a template starts.
VOTES = 2
# Words by which a key phrase may lie outside of the words a template covers.
SLACK = 10
# Places of indexed words that are looked up at a time.
CHUNK = 20_000
FILTER_BITS = 16


@dataclass(frozen=True)
class Template:
    """Words of a licence or of a notice that names it, and the phrases that must stand in a file, all in lower case."""

    label: str
    text: str
    phrases: tuple[str, ...]


# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Opening passages of public licences, and the notices that refer to them.
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy "
        "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software "
        "is furnished to do so subject to the following conditions",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template("mit", "released under the mit license", ("the mit license",)),
    Template("mit", "licensed under the mit license", ("the mit license",)),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice",
        ("redistribution and use in source and binary forms", "with or without modification are permitted"),
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable "
        "law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties "
        "or conditions of any kind either express or implied",
        ("apache license version 2 0", "unless required by applicable law or agreed to in writing"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    *(
        Template(
            f"gpl-{n}.0",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            f"license as published by the free software foundation either version {n} of the license or at your option any later "
            "version this program is distributed in the hope that it will be useful but without any warranty",
            ("gnu general public license", f"version {n} of the license"),
        )
        for n in (2, 3)
    ),
    *(
        Template(
            f"{short}-{n}.0",
            f"licensed under the gnu {name}general public license version {n}",
            (f"gnu {name}general public license version {n}",),
        )
        for short, name, versions in (("gpl", "", (2, 3)), ("lgpl", "lesser ", (2, 3)), ("agpl", "affero ", (3,)))
        for n in versions
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        ("subject to the terms of the mozilla public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    *(
        Template(f"cc-{kind.replace(' ', '-')}-4.0", f"licensed under cc {kind} 4 0", (f"cc {kind} 4 0",))
        for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
    ),
    *(
        Template(
            f"cc-{kind.replace(' ', '-')}-4.0",
            f"this work is licensed under a creative commons {name} 4 0 international license",
            (f"creative commons {name} 4 0",),
        )
        for kind, name in (
            ("by", "attribution"),
            ("by sa", "attribution sharealike"),
            ("by nc", "attribution noncommercial"),
            ("by nd", "attribution noderivatives"),
            ("by nc sa", "attribution noncommercial sharealike"),
            ("by nc nd", "attribution noncommercial noderivatives"),
        )
    ),
)


class Words:
    """The words of templates and base phrases, numbered, and known by their hashes and lengths."""

    def __init__(self, templates: Sequence[Template], base: Sequence[tuple[str, str]]):
        texts = [t for x in templates for t in (x.text, *x.phrases)] + [p for p, _ in base]
        self.words = sorted({w for t in texts for w in t.split(" ")})
        self.number = {w: i for i, w in enumerate(self.words)}
        data, offsets = flat(pa.array(self.words, pa.string()))
        hashes = span_hashes(data, offsets[:-1], offsets[1:], BYTE_BASE)
        self.order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[self.order], np.diff(offsets)[self.order]
        self.likely = np.zeros(1 << FILTER_BITS, bool)
        self.likely[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def numbers(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of every word, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        at = np.flatnonzero(self.likely[hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        known = (self.hashes[place] == hashes[at]) & (self.lengths[place] == lengths[at])
        out[at[known]] = self.order[place[known]]
        return out

    def of(self, text: str) -> np.ndarray:
        return np.array([self.number[w] for w in text.split(" ")], np.int32)


def frequencies(docs: DataFrame, words: Words) -> tuple[np.ndarray, int]:
    """In how many documents each word stands, and how many documents there are. One row for each word reaches the driver."""

    def count(piece: pa.RecordBatch) -> pa.RecordBatch:
        _, starts, ends, hashes, firsts = tokens(piece.column("text"))
        numbers = words.numbers(hashes, ends - starts)
        at = np.flatnonzero(numbers >= 0)
        doc = np.searchsorted(firsts, at, "right") - 1
        pairs = np.unique(doc * len(words.words) + numbers[at])
        found, rows = np.unique(pairs % len(words.words), return_counts=True)
        return batch_of(word=np.append(found, -1).astype(np.int32), rows=np.append(rows, piece.num_rows).astype(np.int64))

    counted = map_pieces(docs, ["text"], count, "word int, rows long").groupBy("word").agg(F.sum("rows").alias("rows")).collect()
    out = np.zeros(len(words.words) + 1, np.int64)
    for row in counted:
        out[row.word] = row.rows
    return out[:-1], int(out[-1])


class Index:
    """Positions of the rare words of each template, and what is needed to verify a match."""

    def __init__(self, templates: Sequence[Template], base: Sequence[tuple[str, str]], words: Words, frequency: np.ndarray, total: int):
        self.words = words
        self.idf = np.log((1 + total) / (1 + frequency))
        self.labels = [t.label for t in templates]
        self.texts = [words.of(t.text) for t in templates]
        self.phrases = [[words.of(p) for p in t.phrases] for t in templates]
        self.base = [(words.of(p), label) for p, label in base]
        self.longest = max(map(len, self.texts), default=0)
        rows = []
        for t, text in enumerate(self.texts):
            distinct = sorted(set(text.tolist()), key=lambda w: (-self.idf[w], w))
            rare = set(distinct[: min(INDEXED, max(VOTES, (len(distinct) + 1) // 2))])
            rows += [(w, t, p) for p, w in enumerate(text.tolist()) if w in rare]
        rows.sort()
        self.postings = np.array(rows, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.postings[:, 0], np.arange(len(words.words) + 1))

    def places(self, phrase: np.ndarray, numbers: np.ndarray, firsts: np.ndarray, by_word: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Where ``phrase`` starts; only places of its rarest word here are looked at."""
        at, bounds = by_word
        k = int(np.argmin(bounds[phrase + 1] - bounds[phrase]))
        starts = at[bounds[phrase[k]] : bounds[phrase[k] + 1]] - k
        doc = np.searchsorted(firsts, starts + k, "right") - 1
        starts = starts[(starts >= firsts[doc]) & (starts + len(phrase) <= firsts[doc + 1])]
        for j, word in enumerate(phrase.tolist()):
            starts = starts[numbers[starts + j] == word]
        return starts

    def chosen(self, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Sorted keys (document, template, word) of the words that documents look up."""
        pairs = np.unique(doc * len(self.words.words) + word)
        d, w = np.divmod(pairs, len(self.words.words))
        count = self.first[w + 1] - self.first[w]
        row = np.repeat(self.first[w], count) + ranges(count)
        d, w, t = np.repeat(d, count), np.repeat(w, count), self.postings[row, 1]
        key = np.unique(self.key(d, t, w))
        dt, w = np.divmod(key, len(self.words.words))
        order = np.lexsort((w, -self.idf[w], dt))
        sizes = np.unique(dt[order], return_counts=True)[1]
        return np.sort(key[order][ranges(sizes) < LOOKED_UP])

    def key(self, doc: np.ndarray, template: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (doc * len(self.labels) + template) * len(self.words.words) + word

    def matches(self, numbers: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(document, template, start, share) of the verified matches, the best of each template in each document."""
        hits = np.flatnonzero(numbers >= 0)
        hits = hits[self.first[numbers[hits] + 1] > self.first[numbers[hits]]]
        if not len(hits):
            return []
        doc, word = np.searchsorted(firsts, hits, "right") - 1, numbers[hits].astype(np.int64)
        chosen = self.chosen(doc, word)
        known = np.flatnonzero(numbers >= 0)
        order = np.argsort(numbers[known], kind="stable")
        by_word = known[order], np.searchsorted(numbers[known][order], np.arange(len(self.words.words) + 1))
        starts: dict[bytes, np.ndarray] = {}
        best: dict[tuple[int, int], tuple[float, int]] = {}
        low = -self.longest
        while low < len(numbers):
            # Templates that start in this stretch, and the places that may agree on them.
            a = int(np.searchsorted(hits, low))
            high = int(hits[a + CHUNK]) if a + CHUNK < len(hits) else len(numbers)
            b = int(np.searchsorted(hits, high + self.longest))
            count = self.first[word[a:b] + 1] - self.first[word[a:b]]
            row = np.repeat(self.first[word[a:b]], count) + ranges(count)
            place, d, w = (np.repeat(x[a:b], count) for x in (hits, doc, word))
            t, start = self.postings[row, 1], place - self.postings[row, 2]
            key = self.key(d, t, w)
            among = chosen[np.minimum(np.searchsorted(chosen, key), len(chosen) - 1)] == key if len(chosen) else np.zeros(len(key), bool)
            keep = (start >= low) & (start < high) & among
            d, t, start, w = d[keep], t[keep], start[keep], w[keep]
            # A word may have several places in a template, and counts once for a start.
            seen = np.unique(np.stack([d, t, start, w]), axis=1) if len(d) else np.empty((4, 0), np.int64)
            found, votes = np.unique(seen[:3], axis=1, return_counts=True) if seen.shape[1] else (seen[:3], np.empty(0, np.int64))
            d, t, start = found[:, votes >= VOTES]
            for template in np.unique(t).tolist():
                mine = t == template
                self.verify(template, d[mine], start[mine], numbers, firsts, by_word, starts, best)
            low = high
        return [(d, t, s, share) for (d, t), (share, s) in sorted(best.items())]

    def verify(self, t, doc, start, numbers, firsts, by_word, starts, best) -> None:
        """Note the best of the candidates of one template in ``best`` if all its key phrases stand where it would."""
        text = self.texts[t]
        good = np.ones(len(doc), bool)
        for phrase in self.phrases[t]:
            name = phrase.tobytes()
            if name not in starts:
                starts[name] = np.sort(self.places(phrase, numbers, firsts, by_word))
            low = np.maximum(start - SLACK, firsts[doc])
            high = np.minimum(start + len(text) + SLACK, firsts[doc + 1]) - len(phrase)
            good &= np.searchsorted(starts[name], high, "right") > np.searchsorted(starts[name], low, "left")
        doc, start = doc[good], start[good]
        same = np.zeros(len(doc), np.int64)
        for j, word in enumerate(text.tolist()):
            at = start + j
            inside = (at >= firsts[doc]) & (at < firsts[doc + 1])
            same += inside & (numbers[np.clip(at, 0, len(numbers) - 1)] == word)
        for d, s, n in zip(doc.tolist(), start.tolist(), same.tolist()):
            share = n / len(text)
            if (d, t) not in best or (share, -s) > (best[d, t][0], -best[d, t][1]):
                best[d, t] = (share, s)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    base: Sequence[tuple[str, str]] = BASE,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, base (start and label of every place of a base phrase, by start) and found (label, start
    and share of the best match of every template that matched, by label). Starts count words from 0; a template whose
    beginning is not in the text may start before it."""
    words = Words(templates, base)
    docs = docs.select(column(id_col).cast("bigint").alias("id"), column(text_col).cast("string").alias("text"))
    index = Index(templates, base, words, *frequencies(docs, words))

    def scan(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, hashes, firsts = tokens(piece.column("text"))
        numbers = words.numbers(hashes, ends - starts)
        known = np.flatnonzero(numbers >= 0)
        order = np.argsort(numbers[known], kind="stable")
        by_word = known[order], np.searchsorted(numbers[known][order], np.arange(len(words.words) + 1))
        phrases: list[list[dict]] = [[] for _ in range(piece.num_rows)]
        raw = None
        for phrase, label in index.base:
            at = index.places(phrase, numbers, firsts, by_word)
            for p, d in zip(at.tolist(), (np.searchsorted(firsts, at, "right") - 1).tolist()):
                raw = data.tobytes() if raw is None else raw
                if all(raw[starts[p + j] : ends[p + j]] == words.words[w].encode() for j, w in enumerate(phrase.tolist())):
                    phrases[d].append({"start": p - int(firsts[d]), "label": label})
        found: list[list[dict]] = [[] for _ in range(piece.num_rows)]
        for d, t, start, share in index.matches(numbers, firsts):
            found[d].append({"label": index.labels[t], "start": start - int(firsts[d]), "share": share})
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
        more = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))
        return batch_of(
            doc_id=piece.column("id"),
            n_words=np.diff(firsts).astype(np.int64),
            base=pa.array([sorted(x, key=lambda r: (r["start"], r["label"])) for x in phrases], kinds),
            found=pa.array([sorted(x, key=lambda r: (r["label"], r["start"])) for x in found], more),
        )

    schema = "doc_id long, n_words long, base array<struct<start:long,label:string>>, found array<struct<label:string,start:long,share:double>>"
    return map_pieces(docs, ["id", "text"], scan, schema)


def license_digest(found: DataFrame) -> DataFrame:
    """Counts and labels of what ``license_scan`` found. The score is the greatest share of a template or base phrase, 0 without any."""
    own = F.array_sort(F.array_distinct(F.col("base.label")))
    every = F.array_sort(F.array_distinct(F.concat(F.col("base.label"), F.col("found.label"))))
    shares = F.concat(F.col("found.share"), F.when(F.size("base") > 0, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.col("base.start")).alias("first_word"),
        F.array_max(F.col("base.start")).alias("last_word"),
        F.array_join(own, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
    )
