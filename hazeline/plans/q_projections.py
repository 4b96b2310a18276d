"""Projection, filter, NULL-handling and scalar-function queries
(SURVEY 2.3, 2.4, 2.5, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.functions import (date_part_strings, district_of, dmy_to_date,
                                dmy_to_iso, int_part)
from hazeline.operators import filters as flt
from hazeline.operators import nulls, projection
from hazeline.operators.aggregates import mean_all_numeric
from hazeline.plans.catalog import register
from hazeline.plans.common import band_live, cleaned, raw, readings, show
from hazeline.plans.oracle import BASE, CLEAN, RAW, STATIONS, mean, rounded, with_
from hazeline.schemas import MEASURES, RAW_MEASURES
from hazeline.sources.adapter import bike_days

RAW_ONLY = [STATIONS, RAW]
_SILVER_COLS = ["reading_id", "measured_at", "station", "address", "district", "latitude",
                "longitude", *MEASURES, "month", "day", "year"]

# Thresholds of the filter queries, chosen near the medians of
# the mapped measures (PM25 <- order total, PM10 <- line price).
PM25_LIMIT = 250000.0
PM10_FLOOR = 50000.0
YEAR = 1998
MONTH = 4


def _cols(cols):
    return ", ".join(f'"{c}"' for c in cols)


# ---- 2.3 projections -------------------------------------------------------

@register("select_columns", with_(BASE, 'SELECT station, district, "PM10", "PM25" FROM silver'))
def select_columns(spark, sf_dir):
    return projection.select_columns(readings(spark, sf_dir), ["station", "district", "PM10", "PM25"])


@register("rename_dotted_column", with_(RAW_ONLY, """
SELECT reading_id, "Measurement date", "Station code", "Address", "Latitude", "Longitude",
  "SO2", "NO2", "O3", "CO", "PM10", "PM2.5" AS "PM25" FROM raw"""))
def rename_dotted_column(spark, sf_dir):
    return projection.rename_column(raw(spark, sf_dir), "PM2.5", "PM25")


@register("add_derived_column", with_(BASE, """
SELECT reading_id, "SO2", "SO2" + CAST(0.004 AS DOUBLE) AS "SO2_shifted" FROM silver"""))
def add_derived_column(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "SO2")
    return projection.add_column(df, "SO2_shifted", F.col("SO2") + F.lit(0.004))


@register("drop_columns", with_(BASE, """
SELECT * EXCLUDE (latitude, longitude, address) FROM silver"""))
def drop_columns(spark, sf_dir):
    # 'no_such_column' is ignored, as Spark's drop does.
    return projection.drop_columns(readings(spark, sf_dir),
                                   ["latitude", "longitude", "address", "no_such_column"])


def _dbl(c):
    return f'CASE WHEN isnan(TRY_CAST("{c}" AS DOUBLE)) THEN NULL ELSE TRY_CAST("{c}" AS DOUBLE) END'


@register("cast_measures", with_(RAW_ONLY, "SELECT reading_id, "
          + ", ".join(f'{_dbl(r)} AS "{m}"' for r, m in zip(RAW_MEASURES, MEASURES))
          + " FROM raw"))
def cast_measures(spark, sf_dir):
    df = raw(spark, sf_dir).select("reading_id", *[F.col(f"`{c}`") for c in RAW_MEASURES])
    return projection.cast_measures(df, RAW_MEASURES, {"PM2.5": "PM25"})


@register("ordered_projection", with_(CLEAN, f"""
SELECT month AS "M", year AS "Y", district, {_cols(MEASURES)} FROM clean"""))
def ordered_projection(spark, sf_dir):
    df = cleaned(spark, sf_dir).select("district", "month", "year", *MEASURES)
    return projection.ordered_projection(df, [("month", "M"), ("year", "Y")])


@register("rest_columns", with_(BASE, f"""
SELECT {_cols([c for c in _SILVER_COLS if c not in ("reading_id", "station", "measured_at", "address")])}
FROM silver"""))
def rest_columns(spark, sf_dir):
    return projection.rest_columns(readings(spark, sf_dir),
                                   ["reading_id", "station", "measured_at", "address"])


@register("positional_projection", with_(BASE, """
SELECT """ + ", ".join(f'{rounded(mean(c))} AS "{c}"' for c in
                       ["latitude", "longitude", *MEASURES, "month", "year"]) + """
FROM silver WHERE district IS NOT NULL GROUP BY district"""))
def positional_projection(spark, sf_dir):
    """Everything but the first column of the district mean table."""
    df = readings(spark, sf_dir).drop("reading_id", "station")
    return show(projection.positional_projection(mean_all_numeric(df, ["district"]), 1))


# ---- 2.4 filters -----------------------------------------------------------

@register("filter_expr_string", with_(BASE, f'SELECT * FROM silver WHERE "PM25" <= {PM25_LIMIT}'))
def filter_expr_string(spark, sf_dir):
    return flt.filter_expr(readings(spark, sf_dir), f"PM25 <= {PM25_LIMIT}")


@register("filter_and", with_(BASE, f"""
SELECT * FROM silver WHERE "PM25" <= {PM25_LIMIT} AND "PM10" >= {PM10_FLOOR}"""))
def filter_and(spark, sf_dir):
    return flt.filter_and(readings(spark, sf_dir), F.col("PM25") <= PM25_LIMIT,
                          F.col("PM10") >= PM10_FLOOR)


@register("filter_not", with_(BASE, f"""
SELECT * FROM silver WHERE NOT ("PM10" <= {PM10_FLOOR})"""))
def filter_not(spark, sf_dir):
    # PM10 holds NULLs (NaN on ingest): they fail both the test and its negation.
    return flt.filter_not(readings(spark, sf_dir), F.col("PM10") <= PM10_FLOOR)


@register("filter_positive_all", with_(BASE, """
SELECT * FROM silver WHERE "SO2" > 0 AND "NO2" > 0 AND "O3" > 0 AND "CO" > 0"""))
def filter_positive_all(spark, sf_dir):
    return flt.filter_positive(readings(spark, sf_dir), ["SO2", "NO2", "O3", "CO"])


@register("filter_year", with_(CLEAN, f"SELECT * FROM clean WHERE year = {YEAR}"))
def filter_year(spark, sf_dir):
    """Year equality on the INT partition column: the scan prunes to one
    year folder (PartitionFilters) instead of comparing text."""
    return cleaned(spark, sf_dir).filter(F.col("year") == YEAR)


@register("outlier_band", with_(CLEAN, "SELECT * FROM clean"))
def outlier_band(spark, sf_dir):
    """The band itself, computed live: one aggregate for the 12 cut-offs
    (scalar subquery, run once), one filtering scan."""
    return band_live(spark, sf_dir)


@register("three_sigma_cutoff", with_(BASE, f"""
SELECT {rounded(mean("PM25"))} AS mean, round(stddev_samp("PM25"), 6) AS stddev,
  round({mean("PM25")} + 3.0 * stddev_samp("PM25"), 6) AS cutoff FROM silver"""))
def three_sigma_cutoff(spark, sf_dir):
    c = flt.sigma_cutoff(readings(spark, sf_dir), "PM25", 3.0)
    return show(c, ["mean"]).select("mean", F.round("stddev", 6).alias("stddev"), F.round("cutoff", 6).alias("cutoff"))


@register("filter_year_month", with_(BASE, f"""
SELECT * FROM silver WHERE year(day) = {YEAR} AND month(day) = {MONTH}"""))
def filter_year_month(spark, sf_dir):
    return flt.filter_year_month(readings(spark, sf_dir), "day", YEAR, MONTH)


# ---- 2.5 NULL handling -----------------------------------------------------

_NULLY = ["SO2", "NO2", "PM10"]


def _nn(cols):
    return " + ".join(f'(CASE WHEN "{c}" IS NOT NULL THEN 1 ELSE 0 END)' for c in cols)


# Readings whose measures are emptied by a rule on the key, so that rows without
# any value exist at every scale.
_EMPTIED = 13
_EMPTIED_SQL = "emptied AS (SELECT reading_id, " + ", ".join(
    f'CASE WHEN reading_id % {_EMPTIED} <> 0 THEN "{c}" END AS "{c}"' for c in _NULLY) + " FROM silver)"


@register("drop_all_null", with_(BASE + [_EMPTIED_SQL], f"""
SELECT reading_id, {_cols(_NULLY)} FROM emptied WHERE {_nn(_NULLY)} > 0"""))
def drop_all_null(spark, sf_dir):
    emptied = readings(spark, sf_dir).select("reading_id", *(
        F.when(F.col("reading_id") % _EMPTIED != 0, F.col(c)).alias(c) for c in _NULLY))
    return nulls.drop_null_rows(emptied, how="all", subset=_NULLY)


@register("drop_thresh", with_(BASE, f"""
SELECT reading_id, {_cols(_NULLY)} FROM silver WHERE {_nn(_NULLY)} >= 2"""))
def drop_thresh(spark, sf_dir):
    return nulls.drop_null_rows(readings(spark, sf_dir).select("reading_id", *_NULLY),
                                how="any", thresh=2, subset=_NULLY)


@register("drop_subset", with_(BASE, 'SELECT * FROM silver WHERE "NO2" IS NOT NULL'))
def drop_subset(spark, sf_dir):
    return nulls.drop_null_rows(readings(spark, sf_dir), how="any", subset=["NO2"])


@register("nan_count", with_(RAW_ONLY, "SELECT " + ", ".join(
    f'CAST(count(CASE WHEN isnan(TRY_CAST("{r}" AS DOUBLE)) THEN 1 END) AS BIGINT) AS "{m}"'
    for r, m in zip(RAW_MEASURES, MEASURES)) + " FROM raw"))
def nan_count(spark, sf_dir):
    """NaN per measure in the raw cast (before NaN becomes NULL on ingest)."""
    df = raw(spark, sf_dir).select(*[F.col(f"`{r}`").try_cast("double").alias(m)
                                     for r, m in zip(RAW_MEASURES, MEASURES)])
    return nulls.nan_count(df, MEASURES)


# Fixed value: the fill text of the reference (its spelling corrected).
FILL_TEXT = "Missing value"


@register("fill_string", with_(BASE, f"""
SELECT reading_id, coalesce(district, '{FILL_TEXT}') AS district,
  coalesce(address, '{FILL_TEXT}') AS address, "NO2" FROM silver"""))
def fill_string(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "district", "address", "NO2")
    return nulls.fill_text(df, FILL_TEXT, ["district", "address", "NO2"])


# ---- 2.9 scalar functions --------------------------------------------------

@register("date_part_strings", with_(RAW_ONLY, """
SELECT reading_id, substr("Measurement date", 1, 4) AS y, substr("Measurement date", 1, 7) AS ym,
  substr("Measurement date", 1, 10) AS ymd, substr("Measurement date", 6, 2) AS m FROM raw"""))
def date_part_strings_q(spark, sf_dir):
    df = raw(spark, sf_dir)
    parts = date_part_strings(F.col("`Measurement date`"))
    return df.select("reading_id", *[c.alias(k) for k, c in parts.items()])


@register("address_district", with_(RAW_ONLY, """
SELECT reading_id, "Address", trim(string_split("Address", ',')[3]) AS district FROM raw"""))
def address_district(spark, sf_dir):
    return raw(spark, sf_dir).select("reading_id", "Address", district_of("Address").alias("district"))


@register("cast_int_parts", with_(RAW_ONLY, """
SELECT reading_id, TRY_CAST(substr("Measurement date", 6, 2) AS INTEGER) AS month,
  TRY_CAST(substr("Measurement date", 1, 4) AS INTEGER) AS year FROM raw"""))
def cast_int_parts(spark, sf_dir):
    df = raw(spark, sf_dir)
    return df.select("reading_id", int_part(F.col("`Measurement date`"), 6, 2).alias("month"),
                     int_part(F.col("`Measurement date`"), 1, 4).alias("year"))


_BIKE = """bike AS (SELECT strftime(o_orderdate, '%d/%m/%Y') AS "Date", o_orderkey FROM orders)"""


@register("reformat_dmy", with_([_BIKE], """
SELECT "Date", strftime(strptime("Date", '%d/%m/%Y'), '%Y-%m-%d') AS iso_date FROM bike"""))
def reformat_dmy(spark, sf_dir):
    return bike_days(spark, sf_dir).select("Date", dmy_to_iso("Date").alias("iso_date"))


@register("date_parts", with_([_BIKE], """
SELECT "Date", CAST(strptime("Date", '%d/%m/%Y') AS DATE) AS day,
  CAST(year(strptime("Date", '%d/%m/%Y')) AS INTEGER) AS year,
  CAST(month(strptime("Date", '%d/%m/%Y')) AS INTEGER) AS month FROM bike"""))
def date_parts(spark, sf_dir):
    # Not "date": Spark takes that for the name of the text column.
    d = dmy_to_date("Date")
    return bike_days(spark, sf_dir).select("Date", d.alias("day"), F.year(d).alias("year"),
                                           F.month(d).alias("month"))
