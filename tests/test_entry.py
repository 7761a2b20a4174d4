"""The entry point, with and without the training-data operators."""

import builtins
import importlib
import sys

import pytest


def test_entry_without_llm(monkeypatch):
    real = builtins.__import__

    def without(name, *a, **b):
        if name.startswith(("corpus_pipeline", "chunkscan.llm")):
            raise ModuleNotFoundError(name, name=name)
        return real(name, *a, **b)

    for name in [n for n in sys.modules if n.startswith(("corpus_pipeline", "chunkscan.llm", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    assert entry.llm is None and "chunked_scan_orders" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_entry_with_broken_llm(monkeypatch):
    """Only an absent package is left out; a broken import inside it is an error."""
    real = builtins.__import__

    def without(name, *a, **b):
        if name.startswith(("corpus_pipeline", "chunkscan.llm")):
            raise ModuleNotFoundError("inside", name="something_else")
        return real(name, *a, **b)

    for name in [n for n in sys.modules if n.startswith(("corpus_pipeline", "chunkscan.llm", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("__spark_entry__")
