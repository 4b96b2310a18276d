"""MLlib queries: PM2.5 regressed on the other measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.functions import safe
from hazeline.operators import ml
from hazeline.plans.catalog import register
from hazeline.plans.common import readings, show
from hazeline.plans.oracle import BASE, rounded, with_

# The reference's feature list and label.
FEATURES = ["SO2", "CO", "PM10", "NO2"]
LABEL = "PM25"
_SPLIT_SQL = (f"CASE WHEN ((reading_id % {ml.SPLIT_P}) * {ml.SPLIT_A} + {ml.SPLIT_B}) % 100 "
              f"< {ml.TRAIN_PERCENT} THEN 'train' ELSE 'test' END")


@register("assemble_features", with_(BASE, "SELECT reading_id, \"PM25\", " + ", ".join(
    f'coalesce("{c}", CAST(\'NaN\' AS DOUBLE)) AS "f_{c}"' for c in FEATURES) + " FROM silver"))
def assemble_features(spark, sf_dir):
    """Feature vectors with ``keep``: a NULL measure becomes NaN, the row
    stays. Returned as one column per vector slot."""
    df = readings(spark, sf_dir).select("reading_id", LABEL, *FEATURES)
    v = ml.assemble(df, FEATURES, handle_invalid="keep").select("reading_id", LABEL, "features")
    return ml.features_as_columns(v, FEATURES)


@register("hash_split", with_(BASE, f"SELECT reading_id, {_SPLIT_SQL} AS part FROM silver"))
def hash_split(spark, sf_dir):
    """Reproducible 75/25 split on the reading key."""
    return ml.hash_split(readings(spark, sf_dir).select("reading_id"), "reading_id")


def _parts(spark, sf_dir):
    df = ml.hash_split(readings(spark, sf_dir).select("reading_id", LABEL, *FEATURES), "reading_id")
    return df.filter(F.col("part") == "train"), df.filter(F.col("part") == "test")


def _fit(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return ml.fit_linear(train, FEATURES, LABEL), test


def _fit_sql() -> list[str]:
    """The least squares of several features by simple regressions: each feature
    is cleared of those before it (q), the label's slopes on what is left (g) give
    the coefficients (b) from the last one back."""
    n = len(FEATURES)
    r = lambda i, j: f"r{i}{j}"  # noqa: E731 - slope of feature j on q of feature i
    ctes = [f"""parts AS (SELECT reading_id, "{LABEL}" AS y, {", ".join(f'"{c}" AS x{j}' for j, c in enumerate(FEATURES))}, {_SPLIT_SQL} AS part FROM silver)""",
            f"""t0 AS (SELECT *, x0 AS q0 FROM parts WHERE part = 'train' AND y IS NOT NULL AND {" AND ".join(f"x{j} IS NOT NULL" for j in range(n))})"""]
    for i in range(n):
        slopes = [f"regr_slope(y, q{i}) AS g{i}", *(f"regr_slope(x{j}, q{i}) AS {r(i, j)}" for j in range(i + 1, n))]
        ctes.append(f"s{i} AS (SELECT {', '.join(slopes)} FROM t{i})")
        if i + 1 < n:
            cleared = " - ".join([f"x{i + 1}", *(f"{r(k, i + 1)} * q{k}" for k in range(i + 1))])
            ctes.append(f"t{i + 1} AS (SELECT t{i}.*, {cleared} AS q{i + 1} FROM t{i}, {', '.join(f's{k}' for k in range(i + 1))})")
    for i in reversed(range(n)):
        solved = " - ".join([f"g{i}", *(f"{r(i, j)} * b{j}" for j in range(i + 1, n))])
        tables = f"b{i + 1}, s{i}" if i + 1 < n else f"s{i}"
        ctes.append(f"b{i} AS (SELECT {', '.join([*(f'b{j}' for j in range(i + 1, n)), f'{solved} AS b{i}'])} FROM {tables})")
    whole = " - ".join(["avg(y)", *(f"avg(x{j}) * any_value(b{j})" for j in range(n))])
    ctes.append(f"fit AS (SELECT {', '.join(f'any_value(b{j}) AS b{j}' for j in range(n))}, {whole} AS b FROM t0, b0)")
    told = " + ".join(["b", *(f"b{j} * x{j}" for j in range(n))])
    ctes.append(f"scored AS (SELECT reading_id, part, y, {told} AS p FROM parts, fit WHERE {' AND '.join(f'x{j} IS NOT NULL' for j in range(n))})")
    return ctes


_FIT = _fit_sql()
_R2 = "1 - avg((y - p) * (y - p)) / var_pop(y)"


@register("linear_fit", with_(BASE + _FIT, " UNION ALL ".join(
    [f"SELECT '{c}' AS term, {rounded(f'b{j}', 3)} AS coefficient FROM fit" for j, c in enumerate(FEATURES)]
    + [f"SELECT 'intercept', {rounded('b', 3)} FROM fit"])))
def linear_fit(spark, sf_dir):
    """Coefficients and intercept of PM25 ~ SO2 + CO + PM10 + NO2 fitted on
    the training part."""
    model, _ = _fit(spark, sf_dir)
    return ml.coefficients(model, FEATURES, spark).withColumn("coefficient", safe.rounded("coefficient", 3))


@register("linear_r2", with_(BASE + _FIT, f"""
SELECT {rounded(_R2)} AS r2, {rounded("sqrt(avg((y - p) * (y - p)))", 3)} AS rmse, count(*) AS n
FROM scored WHERE part = 'train' AND y IS NOT NULL"""))
def linear_r2(spark, sf_dir):
    """Training R2, RMSE and row count of the fit."""
    model, _ = _fit(spark, sf_dir)
    s = model.summary
    out = spark.createDataFrame([(float(s.r2), float(s.rootMeanSquaredError), int(s.numInstances))],
                                "r2 double, rmse double, n long")
    return out.withColumns({"r2": safe.rounded("r2"), "rmse": safe.rounded("rmse", 3)})


@register("linear_predict", with_(BASE + _FIT, f"""
SELECT reading_id, y AS "{LABEL}", {rounded("p", 1)} AS prediction,
  (SELECT {rounded("sqrt(avg((y - p) * (y - p)))", 3)} FROM scored WHERE part = 'test') AS test_rmse,
  (SELECT {rounded(_R2)} FROM scored WHERE part = 'test') AS test_r2
FROM scored WHERE part = 'test'"""))
def linear_predict(spark, sf_dir):
    """Predictions on the held-out part (the reference scored rows it had
    fitted on; here the test part is never seen by the fit), with the
    hold-out RMSE and R2 attached as columns."""
    model, test = _fit(spark, sf_dir)
    pred = ml.predict(model, test, FEATURES, LABEL, ["reading_id"])
    m = ml.regression_metrics(pred, LABEL)
    told = {k: F.lit(m[k]).cast("double") for k in ("rmse", "r2")}
    return pred.withColumns({"prediction": safe.rounded("prediction", 1), "test_rmse": safe.rounded(told["rmse"], 3),
                             "test_r2": safe.rounded(told["r2"])})


# One feature: the fit that SQL has as aggregates.
FEATURE = "PM10"
_PARTS = f"""parts AS (SELECT reading_id, "{LABEL}" AS y, "{FEATURE}" AS x, {_SPLIT_SQL} AS part FROM silver),
train AS (SELECT * FROM parts WHERE part = 'train' AND x IS NOT NULL AND y IS NOT NULL),
fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,
  CAST(regr_count(y, x) AS BIGINT) AS n FROM train)"""


def _fit_one(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return ml.fit_linear(train, [FEATURE], LABEL), test


@register("linear_fit_one", with_(BASE + [_PARTS], f"""
SELECT '{FEATURE}' AS term, {rounded("slope")} AS coefficient FROM fit
UNION ALL SELECT 'intercept', {rounded("intercept", 3)} FROM fit"""))
def linear_fit_one(spark, sf_dir):
    """Slope and intercept of PM25 ~ PM10 fitted on the training part."""
    model, _ = _fit_one(spark, sf_dir)
    out = ml.coefficients(model, [FEATURE], spark)
    digits = safe.rounded("coefficient", 3)
    return out.select("term", F.when(F.col("term") == "intercept", digits).otherwise(safe.rounded("coefficient")).alias("coefficient"))


@register("linear_r2_one", with_(BASE + [_PARTS], f"SELECT {rounded('r2')} AS r2, n FROM fit"))
def linear_r2_one(spark, sf_dir):
    """Training R2 and row count of the one-feature fit."""
    model, _ = _fit_one(spark, sf_dir)
    return show(spark.createDataFrame([(float(model.summary.r2), int(model.summary.numInstances))], "r2 double, n long"))


@register("linear_predict_one", with_(BASE + [_PARTS], f"""
SELECT reading_id, y AS "{LABEL}", {rounded("intercept + slope * x", 3)} AS prediction
FROM parts, fit WHERE part = 'test' AND x IS NOT NULL"""))
def linear_predict_one(spark, sf_dir):
    """Predictions of the one-feature fit on the held-out part."""
    model, test = _fit_one(spark, sf_dir)
    pred = ml.predict(model, test, [FEATURE], LABEL, ["reading_id"])
    return pred.withColumn("prediction", safe.rounded("prediction", 3))
