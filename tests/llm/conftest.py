from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents from (identifier, text) pairs, with columns that operators might use themselves."""

    def make(rows, more="seed long, id string, digest string, n_words int, start int, fp long, kept string"):
        names = [c.split()[0] for c in more.split(", ")]
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[None] * len(names)) for i, t in rows], f"{SCHEMA}, {more}")

    return make


@pytest.fixture(scope="session")
def corpus():
    """Documents with exact and near copies, shared passages, repeated lines, odd white space, empty and long texts."""
    rng = random.Random(5)
    vocabulary = [a + b for a in ("th", "er", "on", "é", "zu", "Ka") for b in ("an", "ti", "ing", "le", "ü", "s.")]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [sentence(rng.randint(8, 60)) for _ in range(12)]
    rows = []
    for i in range(140):
        parts = [rng.choice(passages) if rng.random() < 0.45 else sentence(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        text = rng.choice(("\n", " ", "\n\n", " \t")).join(parts)
        if i and rng.random() < 0.3:
            w = rows[rng.randrange(i)][1].split(" ")
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = rng.choice(("", "other", "two more"))
            text = " ".join(w)
        rows.append((i, text))
    rows += [(200, ""), (201, " \n\t\n"), (202, "one"), (203, passages[3] * 40), (204, rows[7][1]), (205, rows[7][1])]
    return rows
