"""The registered queries where the operators on text cannot be imported."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from checks.queries import QUERIES

REPO = Path(__file__).resolve().parents[1]
COUNTED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("absent", ["xxhash", "keysweep.llm", "keysweep.llm.queries", "tokenizers_that_are_not_there"])
def test_core_queries_load_without_them(absent):
    found = subprocess.run(
        [sys.executable, "-c", f"import sys; sys.modules[{absent!r}] = None; {COUNTED}"], cwd=REPO, capture_output=True, text=True, check=True
    )
    queries, sql = (set(line.split()) for line in found.stdout.splitlines())
    assert queries >= QUERIES.keys() and sql >= QUERIES.keys()
    if absent.startswith("keysweep"):
        assert queries == sql == set(QUERIES)
