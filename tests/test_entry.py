import importlib

import __spark_entry__ as entry


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_library_stands_without_the_optional_subpackage(monkeypatch):
    monkeypatch.setattr(entry, "_llm", lambda: None)
    names = entry.queries()
    assert names and not any(n.startswith("op") for n in names) and "pipeline" not in names
    importlib.import_module("lexmill.plans.registry")
