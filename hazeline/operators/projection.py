"""Column selection, renaming, casting and ordering: single projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.safe import to_double


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[_q(c) for c in cols])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Works for dotted names such as ``PM2.5``, which ``df[name]`` cannot
    resolve."""
    return df.withColumnRenamed(old, new)


def add_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing names are ignored (Spark semantics)."""
    return df.drop(*cols)


def cast_measures(df: DataFrame, measures: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Cast a list of text measures to DOUBLE in one projection (not a loop
    of ``withColumn``); malformed text and NaN become NULL."""
    rename = rename or {}
    targets = set(measures)
    return df.select(*[to_double(_q(c)).alias(rename.get(c, c)) if c in targets
                       else _q(c) for c in df.columns])


def ordered_projection(df: DataFrame, first: list[tuple[str, str]]) -> DataFrame:
    """Put ``(source, name)`` columns first, then every other column."""
    used = {s for s, _ in first}
    return df.select(*[_q(s).alias(n) for s, n in first],
                     *[_q(c) for c in df.columns if c not in used])


def rest_columns(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every column except the keys, from a list computed over ``df.columns``."""
    return df.select(*[_q(c) for c in df.columns if c not in keys])


def positional_projection(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """Columns by position, like ``iloc[:, start:stop]``."""
    return df.select(*[_q(c) for c in df.columns[start:stop]])
