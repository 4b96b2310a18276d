"""Explicit schemas. Nothing downstream relies on inference."""

from __future__ import annotations

from pyspark.sql import types as T

# The six measures of a station reading, in the order the
# reference casts them, and the cut-off rule of the outlier band.
MEASURES = ["SO2", "NO2", "O3", "CO", "PM10", "PM25"]
RAW_MEASURES = ["SO2", "NO2", "O3", "CO", "PM10", "PM2.5"]
BAND_SIGMAS = 2.0          # upper cut-off: mean + 2 * stddev_samp (exclusive)
BAND_QUANTILE = 0.25       # lower cut-off: q25 / 2 (inclusive)
BAND_LOWER_FACTOR = 0.5
THREE_SIGMA = 3.0

RAW_READING_COLUMNS = ["Measurement date", "Station code", "Address",
                       "Latitude", "Longitude"] + RAW_MEASURES

# Readings as they land from a CSV: every column a string.
RAW_READINGS = T.StructType(
    [T.StructField("reading_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in RAW_READING_COLUMNS])

# Readings after ingest: typed measures and derived keys.
READINGS = T.StructType([
    T.StructField("reading_id", T.LongType()),
    T.StructField("measured_at", T.TimestampNTZType()),
    T.StructField("station", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    *[T.StructField(m, T.DoubleType()) for m in MEASURES],
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.DateType()),
    T.StructField("year", T.IntegerType()),
])

_V = T.StructType([T.StructField("v", T.DoubleType())])
# Field names of the real-time service's documents.
IAQI_KEYS = ["co", "h", "no2", "o3", "p", "pm10", "pm25", "r", "so2", "t", "w"]
FORECAST_KEYS = ["o3", "pm10", "pm25", "uvi"]
_DAY = T.ArrayType(T.StructType([
    T.StructField("avg", T.IntegerType()), T.StructField("day", T.StringType()),
    T.StructField("max", T.IntegerType()), T.StructField("min", T.IntegerType())]))

# One real-time snapshot document. Every iaqi value is DOUBLE because the
# service sends 6 in one poll and 6.4 in the next.
# Shape and field names of a real-time document.
SNAPSHOT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.IntegerType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("dominentpol", T.StringType()),
        T.StructField("attributions", T.ArrayType(T.StructType([
            T.StructField("url", T.StringType()), T.StructField("name", T.StringType()),
            T.StructField("logo", T.StringType())]))),
        T.StructField("city", T.StructType([
            T.StructField("geo", T.ArrayType(T.DoubleType())),
            T.StructField("name", T.StringType()), T.StructField("url", T.StringType()),
            T.StructField("location", T.StringType())])),
        T.StructField("iaqi", T.StructType([T.StructField(k, _V) for k in IAQI_KEYS])),
        T.StructField("time", T.StructType([
            T.StructField("s", T.StringType()), T.StructField("tz", T.StringType()),
            T.StructField("v", T.LongType()), T.StructField("iso", T.StringType())])),
        T.StructField("forecast", T.StructType([T.StructField("daily", T.StructType(
            [T.StructField(k, _DAY) for k in FORECAST_KEYS]))])),
        T.StructField("debug", T.StructType([T.StructField("sync", T.StringType())])),
    ])),
])

# District boundaries as a GeoJSON FeatureCollection; geometry is carried
# as an opaque payload (coordinates arrive as raw JSON text).
# Shape of a boundary document (GeoJSON).
GEOJSON = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([T.StructField("SIG_ENG_NM", T.StringType())])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType())])),
    ]))),
])


# Top-level fields of ``data`` each snapshot reader needs. JSON scans do not
# prune nested fields on their own, so readers pass the narrowest schema and
# the parser skips the rest of each document.
FLAT_FIELDS = ("aqi", "idx", "dominentpol", "iaqi", "time", "debug")
FORECAST_FIELDS = ("idx", "forecast", "debug")


def snapshot_schema(fields=None) -> T.StructType:
    if fields is None:
        return SNAPSHOT
    data = SNAPSHOT["data"].dataType
    return T.StructType([SNAPSHOT["status"], T.StructField("data", T.StructType(
        [f for f in data.fields if f.name in fields]))])
