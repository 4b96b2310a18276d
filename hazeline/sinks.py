"""Sinks: CSV folders, year-partitioned tables, latest-snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazeline.sources.files import write_csv


def csv_sink(df: DataFrame, path: str) -> None:
    """Header, overwrite, multi-part folder (one file per task)."""
    write_csv(df, path)


def year_partitioned_sink(df: DataFrame, path: str, year_col: str = "year", fmt: str = "csv") -> None:
    """One write, one folder per year (``year=<y>``), instead of one filter
    and one job per year. Readers prune folders with ``year`` filters. Rows
    whose year is NULL land in the default partition: nothing is dropped."""
    # Rows of a year meet before the write, so a task doesn't write a file for
    # each year; the hint lets Spark split a large year over several tasks.
    w = (df.hint("rebalance", year_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
           .partitionBy(year_col))
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)
