"""The driver contract stands without the optional subpackage, and without a library that it needs."""

import sys

import __spark_entry__


def test_core_without_the_optional_parts(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("ledgerline.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ledgerline.llm", None)
    assert "mar_full" in __spark_entry__.queries() and not any(q.startswith("op") or q == "pipeline" for q in __spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_without_a_library(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("ledgerline.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert "mar_full" in __spark_entry__.queries()
