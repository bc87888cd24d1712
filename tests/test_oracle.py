"""Every registered query against its SQL on the smallest tables."""

import importlib
import sys

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from ledgerline.plans import oracle
from ledgerline.plans.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, n, _, note = compare(spark, con, name, QUERIES[name], SQL.get(name), SMALL)
    assert ok is not False, note
    assert n >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(REGISTRY) == set(oracle.SQL)


def test_the_entry_does_without_the_subpackage_llm(monkeypatch):
    """Taken out, or with a library missing that only it needs."""
    for missing in ("ledgerline.llm", "corpus_pipeline", "public_tokenizers"):
        with monkeypatch.context() as m:
            m.setitem(sys.modules, missing, None)
            for loaded in [name for name in sys.modules if name.startswith("ledgerline.llm") or name == "corpus_pipeline"]:
                if loaded != missing:
                    m.delitem(sys.modules, loaded)
            alone = importlib.reload(entry)
            assert set(alone.queries()) == set(REGISTRY) and set(alone.oracle_sql()) == set(oracle.SQL)
    importlib.reload(entry)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 14
