"""Every registered query against its DuckDB SQL (exact after type
normalisation), at sf0.001; queries without SQL are run for rows only."""

import pytest

from tools.oracle_check import check

SF0001 = "/root/testdata/sf0.001"


def _names():
    # Queries of the llm subpackage have their own tests in tests/llm.
    from hazeline.plans.catalog import QUERIES, load_all
    load_all()
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    status, detail = check(spark, SF0001, [name], verbose=False)[name]
    assert status in ("OK", "rows-only"), f"{name}: {status} {detail}"
    if status == "rows-only":
        assert detail > 0


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "station" in df.columns and "PM25" in df.columns
