"""Ingest: raw text readings to typed readings with derived keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions import district_of, parse_measured, to_double
from hazeline.schemas import MEASURES, RAW_MEASURES


def ingest(raw: DataFrame) -> DataFrame:
    """One projection: rename the dotted column, cast every measure with
    ``try_cast`` (malformed -> NULL, NaN -> NULL), parse the reading time and
    derive district, month, day and year."""
    t = parse_measured(F.col("`Measurement date`"))
    cols = [F.col("reading_id")] if "reading_id" in raw.columns else []
    return raw.select(
        *cols,
        t.alias("measured_at"),
        F.col("`Station code`").try_cast("int").alias("station"),
        F.col("Address").alias("address"),
        district_of(F.col("Address")).alias("district"),
        to_double(F.col("Latitude")).alias("latitude"),
        to_double(F.col("Longitude")).alias("longitude"),
        *[to_double(F.col(f"`{r}`")).alias(m) for r, m in zip(RAW_MEASURES, MEASURES)],
        F.month(t).alias("month"),
        F.to_date(t).alias("day"),
        F.year(t).alias("year"),
    )
