"""Every query with SQL against an independent engine; every other query must run."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))
from oracle import compare, connect

from vestigo.plans.catalog import core_registry

REGISTRY = core_registry()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(REGISTRY.fns))
def test_query(spark, folder, con, name):
    assert compare(spark, name, REGISTRY.fns[name], REGISTRY.sql.get(name), folder, con) == ""


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY.fns) <= set(entry.queries())
