"""Correlation matrix and least-squares lines as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.safe import pairwise_corr


def corr_matrix(df: DataFrame, measures: list[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson matrix: one aggregate computes every
    distinct pair once, then ``stack`` lays out one row per measure."""
    k = len(measures)
    pairs = {(i, j): pairwise_corr(measures[i], measures[j]) for i in range(k) for j in range(i, k)}
    wide = df.agg(*[F.round(c, digits).alias(f"c{i}_{j}") for (i, j), c in pairs.items()])
    rows = ", ".join(f"'{measures[i]}', {i}, " + ", ".join(
        f"c{min(i, j)}_{max(i, j)}" for j in range(k)) for i in range(k))
    names = ", ".join(["measure", "pos"] + [f"`{m}`" for m in measures])
    return wide.selectExpr(f"stack({k}, {rows}) AS ({names})")


def corr_lower_triangle(df: DataFrame, measures: list[str], digits: int = 6) -> DataFrame:
    """Strict lower triangle as a long table (row, col, r), row > col."""
    k = len(measures)
    pairs = [(i, j) for i in range(k) for j in range(i)]
    wide = df.agg(*[F.round(pairwise_corr(measures[i], measures[j]), digits).alias(f"c{i}_{j}")
                    for i, j in pairs])
    rows = ", ".join(f"'{measures[i]}', '{measures[j]}', c{i}_{j}" for i, j in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {rows}) AS (row_measure, col_measure, r)")


def regression_lines(df: DataFrame, pairs: list[tuple[str, str]], digits: int | None = 6) -> DataFrame:
    """OLS ``y = intercept + slope * x`` for each (y, x) pair, one aggregate."""
    aggs = []
    for n, (y, x) in enumerate(pairs):
        aggs += [F.regr_slope(y, x).alias(f"s{n}"), F.regr_intercept(y, x).alias(f"i{n}"),
                 F.regr_r2(y, x).alias(f"r{n}"), F.regr_count(y, x).alias(f"n{n}")]
    wide = df.agg(*aggs)
    rnd = (lambda c: f"round({c}, {digits})") if digits is not None else (lambda c: c)
    rows = ", ".join(f"'{y}', '{x}', {rnd(f's{n}')}, {rnd(f'i{n}')}, {rnd(f'r{n}')}, n{n}"
                     for n, (y, x) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {rows}) AS (y, x, slope, intercept, r2, n)")


def regression_residuals(df: DataFrame, pairs: list[tuple[str, str]], keys: list[str],
                         digits: int = 6) -> DataFrame:
    """Residual ``y - (intercept + slope * x)`` of every point for each pair.
    Line parameters are one struct from a scalar subquery (computed once);
    the points are unpivoted with ``stack`` (one pass over ``df``)."""
    params = {n: (F.regr_slope(y, x), F.regr_intercept(y, x)) for n, (y, x) in enumerate(pairs)}
    line = df.agg(F.struct(*[c.alias(f"{k}{n}") for n, (s, i) in params.items()
                             for k, c in (("s", s), ("i", i))]).alias("p")).select("p").scalar()
    df = df.withColumn("_p", line)
    p = F.col("_p")
    clash = {"y_name", "x_name", "x", "y", "fitted", "residual"} & set(keys)
    if clash:
        raise ValueError(f"key columns clash with output columns: {sorted(clash)}")
    rows = ", ".join(f"'{y}', '{x}', CAST(`{x}` AS DOUBLE), CAST(`{y}` AS DOUBLE), {n}"
                     for n, (y, x) in enumerate(pairs))
    long = df.selectExpr(*[f"`{k}`" for k in keys], "_p",
                         f"stack({len(pairs)}, {rows}) AS (_yn, _xn, _x, _y, _pair)")
    slope = F.coalesce(*[F.when(F.col("_pair") == n, p[f"s{n}"]) for n in params])
    icept = F.coalesce(*[F.when(F.col("_pair") == n, p[f"i{n}"]) for n in params])
    fitted = icept + slope * F.col("_x")
    return long.select(*keys, F.col("_yn").alias("y_name"), F.col("_xn").alias("x_name"),
                       F.col("_x").alias("x"), F.col("_y").alias("y"),
                       F.round(fitted, digits).alias("fitted"),
                       F.round(F.col("_y") - fitted, digits).alias("residual"))
