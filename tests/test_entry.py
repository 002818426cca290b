"""The entry module without the optional operators."""

import importlib
import sys

import __spark_entry__


def test_without_the_optional_operators_the_rest_works(monkeypatch):
    whole = set(__spark_entry__.queries())
    monkeypatch.setitem(sys.modules, "quire.llm", None)
    bare = importlib.reload(__spark_entry__)
    names = set(bare.queries())
    assert names < whole or not any(n.startswith("op") for n in whole)
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
    assert set(bare.oracle_sql()) <= names and len(names) > 70
    monkeypatch.undo()
    assert set(importlib.reload(__spark_entry__).queries()) == whole
