"""Comparison of a query with its SQL in DuckDB: column names, and rows in any order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def oracle_rows(sql: str, sf_dir: str = SF_DIR) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for file in sorted(Path(sf_dir).glob("*.parquet")):
            db.execute(f"create view {file.stem} as select * from '{file}'")
        result = db.execute(sql)
        return [d[0] for d in result.description], result.fetchall()


def by_name(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, sql: str, sf_dir: str = SF_DIR) -> None:
    names, expected = oracle_rows(sql, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got = by_name(df.columns, df.collect())
    want = by_name(names, expected)
    assert sum(got.values()) == sum(want.values())
    assert got == want
