"""The subpackage's queries against SQL, and its removal."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import compare, connect

from vestigo.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(REGISTRY.fns))
def test_query(spark, folder, con, name):
    assert compare(spark, name, REGISTRY.fns[name], REGISTRY.sql.get(name), folder, con) == ""


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2] / "vestigo"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "vestigo.llm" not in p.read_text(), p
