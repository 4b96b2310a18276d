"""MLlib: feature assembly, reproducible split, linear regression.

The fit is MLlib's distributed one (normal equations aggregated across
tasks for a few features), so no data goes to the driver; only the fitted
coefficients (one per feature) come back as a small table.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the split rule: a row is in the training part when
# ((key mod P) * A + B) mod 100 < train percent. Plain integer arithmetic,
# so any engine reproduces it and it does not depend on partitioning
# (``randomSplit`` does).
SPLIT_P, SPLIT_A, SPLIT_B = 1000003, 7919, 104729
TRAIN_PERCENT = 75


def assemble(df: DataFrame, inputs: list[str], out: str = "features",
             handle_invalid: str = "keep") -> DataFrame:
    """``keep`` turns a NULL feature into NaN; ``skip`` drops the row (use
    it before a fit: the solver rejects NaN)."""
    return VectorAssembler(inputCols=inputs, outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def features_as_columns(df: DataFrame, inputs: list[str], vec: str = "features") -> DataFrame:
    arr = vector_to_array(vec)
    return df.select(*[c for c in df.columns if c != vec],
                     *[arr[i].alias(f"f_{c}") for i, c in enumerate(inputs)])


def hash_split(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT,
               col: str = "part") -> DataFrame:
    bucket = F.pmod(F.pmod(F.col(key), F.lit(SPLIT_P)) * SPLIT_A + SPLIT_B, F.lit(100))
    return df.withColumn(col, F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test")))


def fit_linear(df: DataFrame, inputs: list[str], label: str) -> LinearRegressionModel:
    data = assemble(df.select(*inputs, label).filter(F.col(label).isNotNull()), inputs,
                    handle_invalid="skip")
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(data)


def coefficients(model: LinearRegressionModel, inputs: list[str], spark) -> DataFrame:
    """Fitted terms as a table: one row per feature plus the intercept."""
    rows = [(f, float(c)) for f, c in zip(inputs, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "term string, coefficient double")


def predict(model: LinearRegressionModel, df: DataFrame, inputs: list[str], label: str,
            keep: list[str]) -> DataFrame:
    data = assemble(df.select(*keep, *[c for c in inputs if c not in keep], label),
                    inputs, handle_invalid="skip")
    return model.transform(data).select(*keep, label, "prediction")


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> dict:
    """Hold-out RMSE and R2 in one aggregate pass (the evaluator runs one
    pass per metric)."""
    y, p = F.col(label), F.col(prediction)
    r = pred.agg(F.count(y).alias("n"), F.avg((y - p) * (y - p)).alias("mse"),
                 F.var_pop(y).alias("var")).first()
    rmse = r.mse ** 0.5 if r.mse is not None else None
    r2 = 1.0 - r.mse / r.var if r.var else None
    return {"n": r.n, "rmse": rmse, "r2": r2}
