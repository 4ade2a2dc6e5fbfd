"""Audit records that are replaced, and audit tables that are compacted."""

from __future__ import annotations

from pathlib import Path

import keysweep as ks
from keysweep.sinks import audit
from keysweep.sinks.audit import append_audit, audit_record, counts_frame
from keysweep.storage import work_folder

SPEC = ks.TableSpec("t", ("k",), "o")


def put(spark, path, source, day=1):
    append_audit(audit_record(counts_frame(spark, source, 1), SPEC, f"2024-01-0{day} 00:00:00", f"run{source}"), path)


def found(spark, path):
    return sorted((r.last_run_ts[9], r.source_table_count) for r in ks.read_audit(spark, path).collect())


def test_the_old_record_stays_until_the_new_one_is_there(spark, monkeypatch):
    path = work_folder(spark, "audit") + "/audit"
    put(spark, path, 1)
    # A run that dies while it writes leaves a folder without a whole file.
    folder = next(p for p in Path(path).iterdir())
    (folder / "half" / "_temporary").mkdir(parents=True)
    assert found(spark, path) == [("1", 1)]
    put(spark, path, 2)
    assert found(spark, path) == [("1", 2)]


def test_compaction(spark, monkeypatch):
    path = work_folder(spark, "audit") + "/audit"
    for source, day in ((1, 1), (2, 2), (3, 1)):
        put(spark, path, source, day)
    # As older versions wrote them.
    audit_record(counts_frame(spark, 9, 1), SPEC, "2024-01-09 00:00:00", "old").write.parquet(f"{path}/old")
    want = [("1", 3), ("2", 2), ("9", 9)]
    assert found(spark, path) == want
    ks.compact_audit(spark, path)
    assert found(spark, path) == want and len(list(Path(path).iterdir())) == 3
    files = [p for p in Path(path).rglob("*.parquet")]
    assert len(files) == 1
    put(spark, path, 4, 2)
    real = audit.delete_folder

    def late(session, place):
        # A record that is put during a compaction is newer than what is compacted.
        if not done:
            done.append(place)
            put(spark, path, 5, 1)
        real(session, place)

    done = []
    monkeypatch.setattr(audit, "delete_folder", late)
    ks.compact_audit(spark, path)
    assert done and found(spark, path) == [("1", 5), ("2", 4), ("9", 9)]
