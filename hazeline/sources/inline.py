"""Rows given inline in code to a DataFrame (small, fixed inputs such as
test fixtures or lookup rows; never a path for data that grows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def inline_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """``createDataFrame`` with an explicit schema (no inference)."""
    return spark.createDataFrame(rows, schema)
