"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import SF_DIR, assert_same

import __spark_entry__ as entry_points
from checks.oracles import ORACLES
from checks.queries import QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), ORACLES[name])


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert (len(rows), sum(row.id for row in rows)) == (103, 76955)
