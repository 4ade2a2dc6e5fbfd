"""The registered queries and the pipeline over the given tables."""

from __future__ import annotations

import random

import pytest
from compare import SF_DIR, assert_same

import corpus_pipeline
from keysweep.llm import queries as q
from keysweep.llm.bpe import Encoder, Vocabulary


@pytest.mark.parametrize("name", q.ORACLES)
def test_query(spark, name):
    assert_same(q.QUERIES[name](spark, SF_DIR), q.ORACLES[name])


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    import brute

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, docs = {r.doc_id: r.text for r in documents.collect()}, documents
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 4:
            break
        assert docs.columns == documents.columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if k == 0:
            counts = {i: brute.quality_counts(t) for i, t in before.items()}
            failed = {i for i, c in counts.items() if c[0] < 50 or 100 * c[4] > 50 * c[0]}
            assert not failed & after.keys()
            judged = [i for i in labels if i not in failed]
            assert sum((i in after) == bool(labels[i]) for i in judged) > 0.95 * len(judged)
        elif k == 1:
            sample = sorted(before)[:150]
            want = brute.lines([(i, before[i]) for i in sample], 8)
            assert {i: after[i] for i in sample if i in after} == {i: t for i, t in want.items() if brute.words(t)}
        elif k == 2:
            root = brute.linked({i: brute.fingerprint(t, 3) for i, t in before.items()}, 3)
            assert after.keys() == set(root.values())
        elif k == 3:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            some = random.Random(0).sample(sorted(before), 150)
            hit = brute.contamination([(i, before[i]) for i in some], items, 10)
            assert {i for i in some if i in after} == {i for i in some if not hit[i][1]}
        before = after
    encoder = Encoder(Vocabulary(q.vocabulary_path()))
    ids = list(before)
    assert {r.doc_id: r.ids for r in docs.collect()} == dict(zip(ids, [t.tolist() for t in encoder([before[i] for i in ids])]))


def test_pipeline_of_empty_and_odd_tables(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "x " * 5000, "en", "s", 1)]
    rows += [(i, " ".join(f"w{k}" for k in range(70)), None, None, 1) for i in (4, 4, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [4]
