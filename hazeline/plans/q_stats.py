"""Correlation and regression queries over the month climatology."""

from __future__ import annotations

from hazeline.operators import stats
from hazeline.pipelines import REGRESSION_PAIRS
from hazeline.plans.catalog import register
from hazeline.plans.common import readings, show
from hazeline.plans.oracle import BASE, CLEAN, rounded, with_
from hazeline.plans.q_aggregates import MONTH_RAW_SQL, MONTH_SQL, month_table
from hazeline.schemas import MEASURES

MONTH = CLEAN + [f"m AS ({MONTH_SQL})"]


def _r(a, b):
    x = f'CASE WHEN "{b}" IS NOT NULL THEN "{a}" END'
    y = f'CASE WHEN "{a}" IS NOT NULL THEN "{b}" END'
    return f"round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 6)"


_K = len(MEASURES)
_CM = "cm AS (SELECT " + ", ".join(
    f'{_r(MEASURES[i], MEASURES[j])} AS c{i}_{j}' for i in range(_K) for j in range(i, _K)) + " FROM m)"


_MATRIX_SQL = "\nUNION ALL ".join(
    f"SELECT '{MEASURES[i]}' AS measure, {i} AS pos, " + ", ".join(
        f'c{min(i, j)}_{max(i, j)} AS "{MEASURES[j]}"' for j in range(_K)) + " FROM cm"
    for i in range(_K))


@register("corr_matrix", with_(MONTH + [_CM], _MATRIX_SQL))
def corr_matrix(spark, sf_dir):
    """Pearson matrix of the six measures over (district, month) means."""
    return stats.corr_matrix(month_table(spark, sf_dir), MEASURES)


@register("corr_lower_triangle", with_(MONTH + [_CM], "\nUNION ALL ".join(
    f"SELECT '{MEASURES[i]}' AS row_measure, '{MEASURES[j]}' AS col_measure, c{j}_{i} AS r FROM cm"
    for i in range(_K) for j in range(i))))
def corr_lower_triangle(spark, sf_dir):
    return stats.corr_lower_triangle(month_table(spark, sf_dir), MEASURES)


_LINES_SQL = "\nUNION ALL ".join(
    f"""SELECT '{y}' AS y, '{x}' AS x, round(regr_slope("{y}", "{x}"), 6) AS slope,
  round(regr_intercept("{y}", "{x}"), 6) AS intercept, round(regr_r2("{y}", "{x}"), 6) AS r2,
  CAST(regr_count("{y}", "{x}") AS BIGINT) AS n FROM m""" for y, x in REGRESSION_PAIRS)


@register("regression_lines", with_(MONTH, _LINES_SQL))
def regression_lines(spark, sf_dir):
    return stats.regression_lines(month_table(spark, sf_dir), REGRESSION_PAIRS)


# The same over all readings, without the outlier band.
MONTH_RAW = BASE + [f"m AS ({MONTH_RAW_SQL})"]


@register("corr_matrix_uncleaned", with_(MONTH_RAW + [_CM], _MATRIX_SQL))
def corr_matrix_uncleaned(spark, sf_dir):
    return stats.corr_matrix(month_table(spark, sf_dir, readings), MEASURES)


@register("regression_lines_uncleaned", with_(MONTH_RAW, _LINES_SQL))
def regression_lines_uncleaned(spark, sf_dir):
    return stats.regression_lines(month_table(spark, sf_dir, readings), REGRESSION_PAIRS)


def _out(c):
    return rounded(f'"{c}"')


_LINES = "lines AS (SELECT " + ", ".join(
    f'regr_slope("{y}", "{x}") AS s{n}, regr_intercept("{y}", "{x}") AS i{n}'
    for n, (y, x) in enumerate(REGRESSION_PAIRS)) + " FROM m)"


@register("regression_residuals", with_(MONTH + [_LINES], "\nUNION ALL ".join(
    f"""SELECT district, month, '{y}' AS y_name, '{x}' AS x_name, {_out(x)} AS x, {_out(y)} AS y,
  round(i{n} + s{n} * "{x}", 6) AS fitted, round("{y}" - (i{n} + s{n} * "{x}"), 6) AS residual
FROM m, lines""" for n, (y, x) in enumerate(REGRESSION_PAIRS))))
def regression_residuals(spark, sf_dir):
    return show(stats.regression_residuals(month_table(spark, sf_dir), REGRESSION_PAIRS,
                                           ["district", "month"]), ["x", "y"])
