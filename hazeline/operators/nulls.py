"""NULL and NaN handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_null_rows(df: DataFrame, how: str = "any", thresh: int | None = None,
                   subset: list[str] | None = None) -> DataFrame:
    """``na.drop``: ``thresh`` (minimum non-NULL count) overrides ``how``;
    NaN counts as NULL for numeric columns."""
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def nan_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of NaN (not NULL) per numeric column: a conditional count."""
    return df.agg(*[F.count(F.when(F.isnan(c), F.col(c))).alias(c) for c in cols])


def fill_text(df: DataFrame, value: str, subset: list[str]) -> DataFrame:
    """Fill NULL text; numeric columns in the subset are left alone."""
    return df.na.fill(value, subset)
