"""Every registered query of the library against the SQL registered for it, and those without SQL for a result."""

import pytest

from gleaner.plans import registry

ALL, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck, sf_dir, same):
    df = ALL[name](spark, sf_dir)
    want = duck.sql(SQL[name])
    assert same(df.columns, df.collect()) == same(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_query_without_sql_has_rows(name, spark, sf_dir):
    assert ALL[name](spark, sf_dir).count() > 0


def test_entry_works_without_training_data_operators(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ALL) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(("missing", "fine"), [("corpus_pipeline", True), ("gleaner.llm", True), ("numpy", False)])
def test_entry_guards_the_absence_of_the_subpackage_only(monkeypatch, missing, fine):
    import importlib
    import sys

    import __spark_entry__ as entry

    class Absent:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" and missing != "gleaner.llm" or name == "gleaner.llm" and missing == "gleaner.llm":
                raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("gleaner.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Absent(), *sys.meta_path])
    if not fine:
        with pytest.raises(ModuleNotFoundError):
            importlib.reload(entry)
    else:
        assert set(importlib.reload(entry).queries()) == set(ALL)
    monkeypatch.undo()
    importlib.reload(entry)
