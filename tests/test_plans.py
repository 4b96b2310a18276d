"""Physical checks: no Python in any plan; pruning and pushdown reach the
scan; bounded sides are broadcast."""

import pytest

SF0001 = "/root/testdata/sf0.001"

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    # Queries of the llm subpackage have their own tests in tests/llm.
    from hazeline.plans.catalog import QUERIES, load_all
    load_all()
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_no_python_in_plan(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, SF0001)
    plan = _plan(df)
    assert not any(p in plan for p in PYTHON_NODES), plan


def test_year_filter_prunes_partitions(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["filter_year"](spark, SF0001))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_year_month_filter_prunes_folders(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["filter_year_month"](spark, SF0001))
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(day," in plan


def test_projection_prunes_columns(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["select_columns"](spark, SF0001))
    assert "ReadSchema: struct<station:int,district:string,PM10:double,PM25:double>" in plan


def test_filter_pushed_to_scan(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["filter_expr_string"](spark, SF0001))
    assert "PushedFilters: [IsNotNull(PM25), LessThanOrEqual(PM25," in plan


def test_boundaries_broadcast(spark):
    from __spark_entry__ import queries
    df = queries()["boundary_join"](spark, SF0001)
    df.collect()
    assert "BroadcastHashJoin" in _plan(df)


def test_band_cutoffs_pushed_to_scan(spark):
    import contextlib
    import io
    from __spark_entry__ import queries
    df = queries()["outlier_band"](spark, SF0001)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")      # scan details in full (toString abbreviates them)
    text = buf.getvalue()
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert pushed and "GreaterThanOrEqual(SO2," in pushed[0] and "LessThan(PM25," in pushed[0]
    assert "Join" not in text and "Subquery" not in text
