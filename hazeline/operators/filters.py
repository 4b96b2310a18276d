"""Row filters, including the outlier band (the core cleaning operator)."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.operators.quantiles import exact_quantiles
from hazeline.schemas import BAND_LOWER_FACTOR, BAND_QUANTILE, BAND_SIGMAS, THREE_SIGMA


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def filter_expr(df: DataFrame, expr: str) -> DataFrame:
    """Filter by a SQL expression string (parsed by Spark, pushed down)."""
    return df.filter(expr)


def filter_and(df: DataFrame, *conds: Column) -> DataFrame:
    return df.filter(_all(list(conds)))


def filter_not(df: DataFrame, cond: Column) -> DataFrame:
    """Negation under three-valued logic: rows where ``cond`` is NULL are
    dropped as well as rows where it is true."""
    return df.filter(~cond)


def filter_positive(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(_all([F.col(c) > 0 for c in cols]))


def filter_year_month(df: DataFrame, date_col: str, year: int, month: int | None = None,
                      year_col: str | None = "year") -> DataFrame:
    """Rows of one year or month as a range of dates, which reaches the scan's
    row-group statistics. With a column that holds the date's year (a folder
    column of the landed tables) the year is asked for too and prunes folders."""
    first = datetime.date(year, month or 1, 1)
    following = datetime.date(year + (month in (None, 12)), (month or 12) % 12 + 1, 1)
    cond = (F.col(date_col) >= F.lit(first)) & (F.col(date_col) < F.lit(following))
    if year_col in df.columns:
        cond = cond & (F.col(year_col) == year)
    return df.filter(cond)


def cutoff_values(df: DataFrame, measures: list[str], sigmas: float = BAND_SIGMAS,
                  q: float = BAND_QUANTILE, lower_factor: float = BAND_LOWER_FACTOR
                  ) -> dict[str, float | None]:
    """``lo_<m>`` = exact q-quantile * lower_factor and ``hi_<m>`` = mean +
    sigmas * stddev_samp, from the unfiltered rows: a few aggregate passes
    (exact selection, see ``quantiles``) return 2 * len(measures) numbers."""
    extras = [(F.avg(m) + sigmas * F.stddev_samp(m)).alias(f"hi_{m}") for m in measures]
    qv, row = exact_quantiles(df, measures, [q], extras=extras)
    out = {}
    for m in measures:
        v = qv[(m, q)]
        out[f"lo_{m}"] = None if v is None else v * lower_factor
        out[f"hi_{m}"] = row[f"hi_{m}"]
    return out


def band_cutoffs(df: DataFrame, measures: list[str], sigmas: float = BAND_SIGMAS,
                 q: float = BAND_QUANTILE, lower_factor: float = BAND_LOWER_FACTOR) -> DataFrame:
    """The cut-offs as a one-row frame (for inspection and sinks)."""
    cut = cutoff_values(df, measures, sigmas, q, lower_factor)
    return df.sparkSession.createDataFrame(
        [tuple(cut[k] for k in cut)], ", ".join(f"`{k}` double" for k in cut))


def outlier_band(df: DataFrame, measures: list[str], sigmas: float = BAND_SIGMAS,
                 q: float = BAND_QUANTILE, lower_factor: float = BAND_LOWER_FACTOR,
                 cutoffs: dict | None = None) -> DataFrame:
    """Keep a row when every measure satisfies ``lo <= x < hi``; a NULL in
    any measure drops the row. Cut-offs come from the unfiltered rows.

    The cut-offs are computed first (exact quantiles, bounded results) and
    enter the plan as literals: the 12-term filter stays in whole-stage
    codegen and is pushed into the Parquet scan, where row-group statistics
    can skip data. No join and no per-row driver work."""
    cut = cutoffs or cutoff_values(df, measures, sigmas, q, lower_factor)
    conds = []
    for m in measures:
        lo, hi = cut[f"lo_{m}"], cut[f"hi_{m}"]
        if lo is None or hi is None:       # no non-NULL value: no row can pass
            return df.filter(F.lit(False))
        conds.append((F.col(m) >= F.lit(lo)) & (F.col(m) < F.lit(hi)))
    return df.filter(_all(conds))


def sigma_cutoff(df: DataFrame, measure: str, sigmas: float = THREE_SIGMA) -> DataFrame:
    """mean + sigmas * stddev_samp of one measure, as a one-row frame."""
    return df.agg(F.avg(measure).alias("mean"),
                  F.stddev_samp(measure).alias("stddev"),
                  (F.avg(measure) + sigmas * F.stddev_samp(measure)).alias("cutoff"))
