"""The driver's contract, with and without the training-data operators."""

import importlib
import sys

import __spark_entry__ as entry_file


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.count() > 0 and {"pv", "bucket", "mean", "peaks", "end_time"} <= set(df.columns)


def test_sql_belongs_to_queries():
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_without_training_data_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("pulsevault.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    import pulsevault

    monkeypatch.delattr(pulsevault, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "pulsevault.llm", None)
    alone = importlib.reload(entry_file)
    names = alone.queries()
    assert len(names) > 100 and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(alone.oracle_sql()) == set(names)
    monkeypatch.undo()
    importlib.reload(entry_file)
