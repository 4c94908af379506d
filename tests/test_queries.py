"""Every query with SQL against DuckDB on the smallest tables; the others give rows."""

import pytest
from oracle import compare, duck

from folioforge.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.limit(1).count() == 1


def test_entry_without_optional_operators(monkeypatch):
    import builtins
    import importlib
    import sys

    real = builtins.__import__

    def without(name, *a, **k):
        if name == "corpus_pipeline" or name.startswith("folioforge.llm"):
            raise ImportError(name)
        return real(name, *a, **k)

    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLES)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
