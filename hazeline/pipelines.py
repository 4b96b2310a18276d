"""The cleaning, map and correlation jobs as functions over readings.

Each takes typed readings (``plans.readings.ingest`` of a text scan), cleaned or
not: which of both is the caller's choice, as in the reference's two versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline import sinks
from hazeline.operators.aggregates import mean_by, measure_range
from hazeline.operators.filters import outlier_band
from hazeline.operators.joins import boundary_join
from hazeline.operators.stats import corr_lower_triangle, corr_matrix, regression_lines, regression_residuals
from hazeline.schemas import MEASURES

# The key of one station, and the (y, x) pairs that get a line.
STATION_KEYS = ["station", "district", "latitude", "longitude"]
REGRESSION_PAIRS = [("PM10", "PM25"), ("CO", "O3"), ("SO2", "O3")]


def month_grain(cleaned: DataFrame) -> DataFrame:
    """Readings with the time cut to the month and the address to the district."""
    return cleaned.select("station", F.date_format("measured_at", "yyyy-MM").alias("ym"),
                          "district", "latitude", "longitude", *MEASURES, "year")


def clean(readings: DataFrame, out: str) -> DataFrame:
    """The cleaning job: the outlier band, written to ``out/clean`` by year
    (Parquet), ``out/month`` and ``out/by_year`` (CSV). Returns the written rows."""
    sinks.year_partitioned_sink(outlier_band(readings, MEASURES), f"{out}/clean", fmt="parquet")
    cleaned = readings.sparkSession.read.parquet(f"{out}/clean")
    sinks.csv_sink(month_grain(cleaned).drop("year"), f"{out}/month")
    sinks.year_partitioned_sink(cleaned.drop("measured_at", "day"), f"{out}/by_year")
    return cleaned


def station_year_means(readings: DataFrame) -> DataFrame:
    """Yearly mean per station: one group-by over all years."""
    return mean_by(readings, [*STATION_KEYS, "year"], MEASURES)


def map_tables(boundaries: DataFrame, readings: DataFrame, name_col: str = "SIG_ENG_NM") -> tuple[DataFrame, DataFrame]:
    """The map job: boundaries with station-year means, and the common range of
    each measure over the readings."""
    joined = boundary_join(boundaries, name_col, station_year_means(readings), "district")
    return joined, measure_range(readings, MEASURES)


def month_means(readings: DataFrame) -> DataFrame:
    """Mean per district and month of the year, over all years."""
    return mean_by(readings, ["district", "month"], MEASURES)


def correlation_tables(months: DataFrame) -> dict[str, DataFrame]:
    """The correlation job over a month table: matrix, lower triangle, lines and
    residuals."""
    return {"matrix": corr_matrix(months, MEASURES), "triangle": corr_lower_triangle(months, MEASURES),
            "lines": regression_lines(months, REGRESSION_PAIRS),
            "residuals": regression_residuals(months, REGRESSION_PAIRS, ["district", "month"])}
