"""The driver's entry file with and without the training-data part."""

from __future__ import annotations

import importlib
import sys

import pytest

import __spark_entry__ as contract
from workload import QUERIES


@pytest.mark.parametrize("missing", ["corpus_pipeline", "punctua.llm"])
def test_works_without_the_training_part(monkeypatch, missing):
    with monkeypatch.context() as m:
        for name in [n for n in sys.modules if n.startswith(("corpus_pipeline", "punctua.llm"))]:
            m.delitem(sys.modules, name)
        m.setitem(sys.modules, missing, None)
        without = importlib.reload(contract)
        assert set(without.queries()) == set(QUERIES)
        assert set(without.oracle_sql()) == {n for n, q in QUERIES.items() if q.sql is not None}
    assert set(importlib.reload(contract).queries()) >= set(QUERIES)


def test_other_import_errors_are_not_swallowed(monkeypatch):
    monkeypatch.setitem(sys.modules, "workload", None)
    with pytest.raises(ModuleNotFoundError):
        importlib.reload(contract)
    monkeypatch.undo()
    importlib.reload(contract)
