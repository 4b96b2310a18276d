"""Correlation, regression and ML invariants."""

import math

from pyspark.sql import functions as F

from hazeline.operators import ml, stats
from hazeline.sources.inline import inline_rows

# CO is constant.
ROWS = [(0.011, 0.5, 12.0, 8.0), (0.013, 0.5, 30.0, 21.0), (0.017, 0.5, 25.0, 9.0), (0.019, 0.5, 41.0, 33.0)]


def test_constant_column_gives_null_not_error(spark):
    df = inline_rows(spark, ROWS, "SO2 double, CO double, PM10 double, PM25 double")
    m = {r.measure: r for r in stats.corr_matrix(df, ["SO2", "CO", "PM10", "PM25"]).collect()}
    assert m["CO"]["PM10"] is None and m["SO2"]["CO"] is None
    assert m["SO2"]["SO2"] == 1.0
    for r in m.values():
        for c in ("SO2", "PM10", "PM25"):
            v = r[c]
            assert v is None or abs(v) <= 1.0


def test_pairwise_complete(spark):
    df = inline_rows(spark, [(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 7.0), (4.0, 8.2)],
                     "a double, b double")
    r = stats.corr_lower_triangle(df, ["a", "b"]).collect()[0].r
    full = inline_rows(spark, [(1.0, 2.0), (2.0, 4.1), (4.0, 8.2)], "a double, b double")
    assert r == round(full.select(F.corr("a", "b")).first()[0], 6)


def test_residuals_sum_to_zero(spark):
    df = spark.range(1, 200).select("id", F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 3 + F.sin("id") * 5).alias("y"))
    res = stats.regression_residuals(df, [("y", "x")], ["id"], digits=12)
    s = res.agg(F.sum("residual")).first()[0]
    assert abs(s) < 1e-6


def test_one_feature_fit_equals_regr(spark):
    df = spark.range(1, 500).select(F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 2.5 + F.cos("id") * 7 + 3).alias("y"))
    model = ml.fit_linear(df, ["x"], "y")
    row = df.agg(F.regr_slope("y", "x").alias("s"), F.regr_intercept("y", "x").alias("i")).first()
    assert math.isclose(model.coefficients[0], row.s, rel_tol=1e-9)
    assert math.isclose(model.intercept, row.i, rel_tol=1e-9)


def test_hash_split_disjoint_complete(spark):
    df = ml.hash_split(spark.range(0, 20000).withColumnRenamed("id", "k"), "k")
    counts = {r.part: r["count"] for r in df.groupBy("part").count().collect()}
    assert counts["train"] + counts["test"] == 20000
    assert 0.70 < counts["train"] / 20000 < 0.80
    again = ml.hash_split(spark.range(0, 20000).withColumnRenamed("id", "k").repartition(3), "k")
    assert df.join(again, ["k", "part"]).count() == 20000   # independent of partitioning


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.range(1, 300).select((F.col("id") * 1.0).alias("y"),
                                    (F.col("id") * 1.0 + F.sin("id")).alias("prediction"))
    m = ml.regression_metrics(df, "y")
    for name in ("rmse", "r2"):
        ev = RegressionEvaluator(labelCol="y", metricName=name).evaluate(df)
        assert math.isclose(m[name], ev, rel_tol=1e-9)
