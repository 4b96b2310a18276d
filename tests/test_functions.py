"""Ingest edge cases (FIXTURES section 4) on inline rows."""

import math

from pyspark.sql import functions as F

from hazeline.functions import district_of, dmy_to_date, dmy_to_iso, to_double
from hazeline.plans.readings import ingest
from hazeline.schemas import RAW_READINGS
from hazeline.sources.inline import inline_rows

GOOD = "19, Riverside-ro 35-gil, Central-gu, Metro City, Countryland"


def _raw(spark, **over):
    base = {"reading_id": 1, "Measurement date": "2017-01-01 00:00", "Station code": "101",
            "Address": GOOD, "Latitude": "37.57", "Longitude": "126.97", "SO2": "0.012",
            "NO2": "0.031", "O3": "0.027", "CO": "0.6", "PM10": "44.0", "PM2.5": "18.0"}
    base.update(over)
    return inline_rows(spark, [tuple(base[f.name] for f in RAW_READINGS.fields)], RAW_READINGS)


def test_district_good_and_short(spark):
    df = inline_rows(spark, [(GOOD,), ("short",), ("a,b, c ,d",)], "a string")
    got = [r.d for r in df.select(district_of("a").alias("d")).collect()]
    assert got == ["Central-gu", None, "c"]


def test_malformed_missing_nan_become_null(spark):
    df = inline_rows(spark, [("bad",), (None,), ("NaN",), ("1.5",), ("",)], "x string")
    got = [r.v for r in df.select(to_double("x").alias("v")).collect()]
    assert got == [None, None, None, 1.5, None]


def test_ingest_types_and_keys(spark):
    r = ingest(_raw(spark, SO2="bad", NO2=None, PM10="NaN")).collect()[0]
    assert r.station == 101 and r.district == "Central-gu"
    assert r.SO2 is None and r.NO2 is None and r.PM10 is None and r.PM25 == 18.0
    assert (r.year, r.month, str(r.day)) == (2017, 1, "2017-01-01")


def test_year_outside_range_kept(spark):
    r = ingest(_raw(spark, **{"Measurement date": "2016-05-02 13:00"})).collect()[0]
    assert r.year == 2016 and r.month == 5


def test_dmy_dates(spark):
    df = inline_rows(spark, [("31/12/2017",), ("bad",)], "d string")
    rows = df.select(dmy_to_date("d").alias("a"), dmy_to_iso("d").alias("b")).collect()
    assert str(rows[0].a) == "2017-12-31" and rows[0].b == "2017-12-31"
    assert rows[1].a is None and rows[1].b is None


def test_no_nan_survives_ingest(spark):
    df = ingest(_raw(spark, PM10="NaN", CO="nan"))
    vals = df.select(F.col("PM10"), F.col("CO")).collect()[0]
    assert all(v is None or not math.isnan(v) for v in vals)


def test_means_keep_all_digits(spark):
    from hazeline.operators.aggregates import mean_by
    df = inline_rows(spark, [("a", 37.572016, 0.00002, 1e15), ("a", 37.572041, 0.00004, 3e15)], "k string, x double, y double, z double")
    r = mean_by(df, ["k"], ["x", "y", "z"]).first()
    assert math.isclose(r.x, 37.5720285, rel_tol=1e-14) and math.isclose(r.y, 0.00003, rel_tol=1e-12) and r.z == 2e15


def test_infinite_text_is_no_reading(spark):
    df = inline_rows(spark, [("Infinity",), ("-inf",), ("1e15",), ("2",)], "x string")
    assert [r.v for r in df.select(to_double("x").alias("v")).collect()] == [None, None, 1e15, 2.0]


def test_rounded_halves_fall_alike(spark):
    from hazeline.functions.safe import rounded
    df = inline_rows(spark, [(0.0384375,), (0.03843749999999999,), (-1e-12,)], "x double")
    assert [str(r.v) for r in df.select(rounded("x").alias("v")).collect()] == ["0.038438", "0.038438", "0.0"]
