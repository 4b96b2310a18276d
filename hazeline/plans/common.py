"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hazeline.functions.safe import rounded
from hazeline.operators.filters import outlier_band
from hazeline.pipelines import STATION_KEYS  # noqa: F401 - for the query modules
from hazeline.schemas import MEASURES
from hazeline.sources import landing



def show(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A query's result with its computed columns (by default every DOUBLE)
    rounded; the operators themselves don't round."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: rounded(f"`{c}`") for c in cols})


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text readings (landed bronze)."""
    return landing.bronze(spark, sf_dir)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings (landed silver, partitioned by year)."""
    return landing.silver(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings inside the six-measure outlier band (landed gold)."""
    return landing.gold(spark, sf_dir)


def band_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlier band computed now over the typed readings."""
    return outlier_band(readings(spark, sf_dir), MEASURES)
