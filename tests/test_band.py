"""Outlier band: boundaries, NULLs, cut-offs from unfiltered rows, plan."""

from pyspark.sql import functions as F

from hazeline.operators.filters import band_cutoffs, outlier_band
from hazeline.sources.inline import inline_rows


def _frame(spark, xs):
    return inline_rows(spark, [(i, x) for i, x in enumerate(xs)], "id int, x double")


def test_band_bounds_inclusive_exclusive(spark):
    # q25 = 2.0, so the lower cut-off 1.0 is itself a data value.
    xs = [1.0] * 10 + [2.0] * 30 + [3.0] * 60 + [0.5, None]
    df = _frame(spark, xs)
    cut = band_cutoffs(df, ["x"]).collect()[0]
    lo, hi = cut.lo_x, cut.hi_x
    assert lo == 1.0
    kept = {r.x for r in outlier_band(df, ["x"]).collect()}
    assert lo in kept                       # on the lower cut-off: kept
    assert 0.5 not in kept
    assert all(lo <= v < hi for v in kept)
    assert None not in kept                 # NULL measure: dropped
    expect = {v for v in xs if v is not None and lo <= v < hi}
    assert kept == expect


def test_upper_cutoff_exclusive(spark):
    # Choose values so that one row sits exactly on mean + 2 * stddev.
    df = _frame(spark, [0.0] * 8 + [10.0, 10.0])
    c = band_cutoffs(df, ["x"], q=0.0, lower_factor=0.0).collect()[0]
    df2 = df.union(_frame(spark, [c.hi_x]).select((F.col("id") + 100).alias("id"), "x"))
    c2 = band_cutoffs(df2, ["x"], q=0.0, lower_factor=0.0).collect()[0]
    out = outlier_band(df2, ["x"], q=0.0, lower_factor=0.0).collect()
    assert all(r.x < c2.hi_x for r in out)
    on_edge = df2.filter(F.col("x") == F.lit(c2.hi_x)).count()
    assert len(out) == df2.count() - on_edge


def test_band_is_subset_and_pushed_down(spark, tmp_path):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("a"),
                                     (F.col("id") % 89).cast("double").alias("b"))
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = outlier_band(df, ["a", "b"])
    assert out.count() <= df.count()
    assert out.join(df, "id", "left_anti").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b), GreaterThanOrEqual(a," in plan
    assert "Python" not in plan and "Join" not in plan and "Subquery" not in plan
