"""Every registered query against its DuckDB oracle on the smallest tables
(``python -m tests.oracle_compare`` runs the same at sf0.01)."""

from __future__ import annotations

import pytest

from tests.conftest import SF0001
from tests.oracle_compare import compare, duck
from twinsift.registry import oracle_sql, queries

_CON = {}


def _duck():
    if "c" not in _CON:
        _CON["c"] = duck(SF0001)
    return _CON["c"]


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, queries()[name], oracle_sql().get(name), SF0001, _duck())
    assert r["status"] in ("match", "rows-only"), r


def test_entry_runs(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() == 4599
    assert set(mod.oracle_sql()) <= set(mod.queries())
