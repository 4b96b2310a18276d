"""Scan and sink queries: every file is written from the
driver tables into the shared scratch folder, then scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline import pipelines, sinks
from hazeline.plans.catalog import register
from hazeline.plans.common import cleaned, raw, show
from hazeline.plans.oracle import BASE, CLEAN, RAW, STATIONS, out_means, with_
from hazeline.plans.q_aggregates import DISTRICT_MEAN_OUT, district_mean_table
from hazeline.plans.readings import ingest
from hazeline.schemas import MEASURES, RAW_MEASURES
from hazeline.sources import adapter, files, landing

RAW_ONLY = [STATIONS, RAW]


def readings_csv(spark, sf_dir) -> str:
    """The raw readings as a multi-part CSV folder with a header, compressed."""
    return landing.derived(spark, sf_dir, "readings_csv",
                           lambda p: files.write_csv(raw(spark, sf_dir), p, compressed=True))


_TEXT = ["Measurement date", "Station code", "Address", "Latitude", "Longitude", *RAW_MEASURES]


def _q(cols):
    return ", ".join(f'"{c}"' for c in cols)


@register("csv_string_scan", with_(RAW_ONLY, f"""
SELECT CAST(reading_id AS VARCHAR) AS reading_id, {_q(_TEXT)} FROM raw"""))
def csv_string_scan(spark, sf_dir):
    return files.csv_text(spark, readings_csv(spark, sf_dir))


@register("csv_infer_scan", with_(RAW_ONLY, """
SELECT CAST(reading_id AS INTEGER) AS reading_id,
  CAST(strptime("Measurement date", '%Y-%m-%d %H:%M') AS TIMESTAMP) AS "Measurement date",
  CAST("Station code" AS INTEGER) AS "Station code", "Address",
  CAST("Latitude" AS DOUBLE) AS "Latitude", CAST("Longitude" AS DOUBLE) AS "Longitude",
  "SO2", CAST("NO2" AS DOUBLE) AS "NO2", CAST("O3" AS DOUBLE) AS "O3", CAST("CO" AS DOUBLE) AS "CO",
  CAST("PM10" AS DOUBLE) AS "PM10", CAST("PM2.5" AS DOUBLE) AS "PM2.5" FROM raw"""))
def csv_infer_scan(spark, sf_dir):
    """Inferred types: the malformed 'bad' keeps SO2 a STRING column; NaN
    keeps PM10 a DOUBLE; the time text is inferred as a timestamp."""
    return files.csv_inferred(spark, readings_csv(spark, sf_dir))


TYPED_READINGS = T.StructType([
    T.StructField("reading_id", T.LongType()),
    T.StructField("Measurement date", T.StringType()),
    T.StructField("Station code", T.IntegerType()),
    T.StructField("Address", T.StringType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    *[T.StructField(m, T.DoubleType()) for m in RAW_MEASURES]])


@register("csv_typed_scan", with_(RAW_ONLY, f"""
SELECT reading_id, "Measurement date", CAST("Station code" AS INTEGER) AS "Station code", "Address",
  CAST("Latitude" AS DOUBLE) AS "Latitude", CAST("Longitude" AS DOUBLE) AS "Longitude",
  {", ".join(f'TRY_CAST("{m}" AS DOUBLE) AS "{m}"' for m in RAW_MEASURES)} FROM raw"""))
def csv_typed_scan(spark, sf_dir):
    """Declared types: 'bad' becomes NULL (PERMISSIVE), 'NaN' stays NaN."""
    return files.csv_typed(spark, readings_csv(spark, sf_dir), TYPED_READINGS)


LATIN1 = "ISO-8859-1"
INVOICE = T.StructType([
    T.StructField("InvoiceNo", T.LongType()), T.StructField("LineNo", T.IntegerType()),
    T.StructField("Description", T.StringType()), T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()), T.StructField("Amount", T.DoubleType())])


def invoices_csv(spark, sf_dir) -> str:
    return landing.derived(spark, sf_dir, "invoices_latin1_csv", lambda p: files.write_csv(
        adapter.invoice_lines(spark, sf_dir), p, encoding=LATIN1))


@register("csv_latin1_scan", """
SELECT l.l_orderkey AS "InvoiceNo", l.l_linenumber AS "LineNo",
  translate(p.p_name, 'aeiou', 'áéíóú') AS "Description", CAST(l.l_quantity AS INTEGER) AS "Quantity",
  strftime(l.l_shipdate, '%m/%d/%Y %H:%M') AS "InvoiceDate", l.l_extendedprice AS "Amount"
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def csv_latin1_scan(spark, sf_dir):
    """A CSV written in ISO-8859-1, read back with that charset."""
    return files.csv_typed(spark, invoices_csv(spark, sf_dir), INVOICE, encoding=LATIN1)


@register("csv_dir_scan", with_(BASE, "SELECT * FROM silver"))
def csv_dir_scan(spark, sf_dir):
    """Read-back of the multi-part folder, then the same ingest as landing."""
    df = files.csv_dir(spark, readings_csv(spark, sf_dir))
    return ingest(df.withColumn("reading_id", F.col("reading_id").try_cast("long")))


def events_json(spark, sf_dir) -> str:
    def build(p):
        e = adapter.table(spark, sf_dir, "events")
        e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                 "user_id", "event_type", "value",
                 F.from_json("props", "k INT").alias("props")).write.mode("overwrite").json(p)
    return landing.derived(spark, sf_dir, "events_json", build)


EVENT_DOC = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StructType([T.StructField("k", T.IntegerType())]))])


@register("json_scan", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_scan(spark, sf_dir):
    """JSON lines with a nested object, scanned with a declared schema;
    the nested field is read by path."""
    df = files.json_lines(spark, events_json(spark, sf_dir), EVENT_DOC)
    return df.select("event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"))


def boundaries_geojson(spark, sf_dir) -> str:
    return landing.derived(spark, sf_dir, "boundaries_geojson", lambda p: files.write_geojson(
        adapter.boundaries(spark, sf_dir), p))


@register("geojson_boundaries", """
SELECT n_name AS "SIG_ENG_NM", 'Polygon' AS geometry_type,
  printf('[[%d,%d]]', n_nationkey, n_regionkey) AS geometry_coordinates FROM nation""")
def geojson_boundaries(spark, sf_dir):
    """Pretty-printed GeoJSON to (name, geometry) rows; coordinates arrive
    as raw JSON text."""
    g = files.geojson_features(spark, boundaries_geojson(spark, sf_dir))
    return g.select("SIG_ENG_NM", F.col("geometry.type").alias("geometry_type"),
                    F.col("geometry.coordinates").alias("geometry_coordinates"))


# ---- sinks -----------------------------------------------------------------

def _month_grain(spark, sf_dir):
    return pipelines.month_grain(cleaned(spark, sf_dir))


_RT = f"""SELECT strftime(measured_at, '%Y-%m') AS ym, district, CAST(count(*) AS BIGINT) AS n, {out_means()}
FROM clean GROUP BY 1, 2"""


@register("csv_sink_roundtrip", with_(CLEAN, _RT))
def csv_sink_roundtrip(spark, sf_dir):
    """Cleaned month-grain readings to a CSV folder, read back with declared
    types; the result is the per (month, district) aggregate of the copy."""
    path = landing.fresh(spark, "csv_sink")
    df = _month_grain(spark, sf_dir)
    sinks.csv_sink(df, path)
    back = files.csv_typed(spark, path, df.schema)
    return _count_and_means(back, ["ym", "district"])


def _count_and_means(df, keys):
    return show(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                      *[F.avg(m).alias(m) for m in MEASURES]))


@register("csv_sink_aggregate", with_(BASE, DISTRICT_MEAN_OUT))
def csv_sink_aggregate(spark, sf_dir):
    """The district mean table written as CSV (keys are columns, no index)
    and read back with its schema: doubles survive the text round trip."""
    path = landing.fresh(spark, "csv_aggregate")
    df = district_mean_table(spark, sf_dir)
    sinks.csv_sink(df, path)
    return show(files.csv_typed(spark, path, df.schema))


@register("year_partitioned_sink", with_(CLEAN, f"""
SELECT year, CAST(count(*) AS BIGINT) AS n, {out_means()} FROM clean GROUP BY year"""))
def year_partitioned_sink(spark, sf_dir):
    """Cleaned readings written once, one folder per year; read back (year
    from the folder names) and aggregated per year."""
    path = landing.fresh(spark, "by_year")
    df = cleaned(spark, sf_dir).drop("measured_at", "day")
    sinks.year_partitioned_sink(df, path)
    back = files.csv_typed(spark, path, df.schema)
    return _count_and_means(back, ["year"])
