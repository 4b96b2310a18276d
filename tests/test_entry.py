"""The entry module gives its own queries whatever is missing elsewhere."""

import importlib

import __spark_entry__ as entry


def test_queries_without_the_training_data_part(monkeypatch):
    real = importlib.import_module

    def missing(name, package=None):
        if name.startswith(("hazeline.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, package)

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    found = entry.queries()
    assert "station_year_mean" in found and "asof_last_view" in found
    assert "pipeline" not in found and not any(n.startswith("op1") for n in found)
    assert set(entry.oracle_sql()) == set(found)
