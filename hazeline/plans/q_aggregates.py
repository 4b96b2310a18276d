"""Aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline import pipelines
from hazeline.functions import safe
from hazeline.operators import aggregates as agg
from hazeline.plans.catalog import register
from hazeline.plans.common import STATION_KEYS, cleaned, readings, show
from hazeline.plans.oracle import BASE, CLEAN, mean, means, out_means, rounded, with_
from hazeline.schemas import MEASURES
from hazeline.sources import landing
from hazeline.sources.adapter import bike_days

Z = "CAST(0.0 AS DOUBLE)"


def _profile_sql(stats, src="silver"):
    one = {
        "count": lambda m: f'CAST(count("{m}") AS DOUBLE)',
        "mean": lambda m: rounded(mean(m)),
        "stddev": lambda m: f'round(stddev_samp("{m}"), 6)',
        "min": lambda m: f'min("{m}") + {Z}',
        "max": lambda m: f'max("{m}") + {Z}',
        "25%": lambda m: f'quantile_disc("{m}", 0.25)',
        "50%": lambda m: f'quantile_disc("{m}", 0.5)',
        "75%": lambda m: f'quantile_disc("{m}", 0.75)',
    }
    return "\nUNION ALL ".join(
        f"SELECT '{s}' AS summary, {i} AS stat_order, "
        + ", ".join(f'{one[s](m)} AS "{m}"' for m in MEASURES) + f" FROM {src}"
        for i, s in enumerate(stats))


@register("profile_summary", with_(BASE, _profile_sql(agg.PROFILE_STATS)))
def profile_summary(spark, sf_dir):
    """count, mean, stddev, min, quartiles, max of each measure: one pass."""
    return _profile(agg.profile(readings(spark, sf_dir), MEASURES, agg.PROFILE_STATS))


def _profile(df):
    """Rounds the row of means; counts and values of the data stay as they are."""
    return df.withColumns({m: F.when(F.col("summary") == "mean", safe.rounded(m)).otherwise(F.col(m)) for m in MEASURES})


@register("profile_describe", with_(BASE, _profile_sql(agg.DESCRIBE_STATS)))
def profile_describe(spark, sf_dir):
    return _profile(agg.profile(readings(spark, sf_dir), MEASURES, agg.DESCRIBE_STATS))


@register("global_max", with_(BASE, 'SELECT max("PM25") AS "max(PM25)" FROM silver'))
def global_max(spark, sf_dir):
    return readings(spark, sf_dir).agg({"PM25": "max"})


_F4_NUM = ["reading_id", "station", "latitude", "longitude", *MEASURES, "month", "year"]


@register("group_max_all", with_(BASE, "SELECT district, " + ", ".join(
    f'max("{c}") AS "max({c})"' for c in _F4_NUM) + " FROM silver GROUP BY district"))
def group_max_all(spark, sf_dir):
    """Max of every numeric column per district; text columns are left out.
    Spark keeps the NULL district as its own group."""
    df = readings(spark, sf_dir).drop("measured_at", "day")
    return agg.max_all_numeric(df, ["district"])


_F5 = ["station", "latitude", "longitude", *MEASURES]


def district_mean_table(spark, sf_dir):
    df = readings(spark, sf_dir).select("district", *_F5)
    return agg.mean_all_numeric(df, ["district"])


DISTRICT_MEAN_SQL = f"SELECT district, {means(_F5)} FROM silver WHERE district IS NOT NULL GROUP BY district"
DISTRICT_MEAN_OUT = DISTRICT_MEAN_SQL.replace(means(_F5), out_means(_F5))


@register("district_mean", with_(BASE, DISTRICT_MEAN_OUT))
def district_mean(spark, sf_dir):
    """District mean over all years of every numeric column (station code,
    latitude and longitude are averaged too, as in the reference)."""
    return show(district_mean_table(spark, sf_dir))


@register("district_avg_named", with_(BASE, f"""
SELECT district, {out_means(MEASURES, "avg_")} FROM silver GROUP BY district"""))
def district_avg_named(spark, sf_dir):
    return show(agg.mean_by(readings(spark, sf_dir), ["district"], MEASURES, prefix="avg_",
                            drop_null_keys=False))


@register("mean_all_but_keys", with_(CLEAN, f"""
SELECT district, month, {out_means([*MEASURES, "year"])} FROM clean GROUP BY district, month"""))
def mean_all_but_keys(spark, sf_dir):
    """Mean of every numeric column except the keys, names kept."""
    df = cleaned(spark, sf_dir).select("district", "month", "year", *MEASURES)
    keys = ["district", "month"]
    rest = [c for c in agg.numeric_columns(df) if c not in keys]
    return show(agg.mean_by(df, keys, rest, drop_null_keys=False))


_F9_REST = [m for m in MEASURES if m != "PM25"]


@register("mean_measure_key", with_(CLEAN, f"""
SELECT district, month, "PM25", {out_means(_F9_REST)} FROM clean GROUP BY district, month, "PM25" """))
def mean_measure_key(spark, sf_dir):
    """A measure among the group keys: mean of the other measures per
    (district, month, PM25) on typed columns."""
    df = cleaned(spark, sf_dir).select("district", "month", *MEASURES)
    return show(agg.mean_by(df, ["district", "month", "PM25"], _F9_REST, drop_null_keys=False), _F9_REST)


def month_table(spark, sf_dir, source=cleaned):
    """Month climatology: mean per (district, month of year) over all years of
    the cleaned readings or of another source. It has a row per district and
    month, is read by several queries, and so is written once."""
    path = landing.derived(spark, sf_dir, f"months_{source.__name__}", lambda p: pipelines.month_means(
        source(spark, sf_dir)).write.mode("overwrite").parquet(p))
    return spark.read.parquet(path)


MONTH_SQL = f"""SELECT district, month, {means()} FROM clean
WHERE district IS NOT NULL AND month IS NOT NULL GROUP BY district, month"""


MONTH_OUT = MONTH_SQL.replace(means(), out_means())
MONTH_RAW_SQL = MONTH_SQL.replace("FROM clean", "FROM silver")


@register("month_climatology", with_(CLEAN, MONTH_OUT))
def month_climatology(spark, sf_dir):
    return show(month_table(spark, sf_dir))


@register("month_climatology_uncleaned", with_(BASE, MONTH_OUT.replace("FROM clean", "FROM silver")))
def month_climatology_uncleaned(spark, sf_dir):
    """The climatology over all readings, without the outlier band."""
    return show(month_table(spark, sf_dir, readings))


@register("daily_mean", with_(BASE, f"""
SELECT day, {out_means()} FROM silver WHERE day IS NOT NULL GROUP BY day"""))
def daily_mean(spark, sf_dir):
    """Daily mean over all stations."""
    return show(agg.mean_by(readings(spark, sf_dir), ["day"], MEASURES))


_INVOICE_COLS = ["InvoiceNo", "LineNo", "Description", "Quantity", "InvoiceDate", "Amount"]
#: Cells emptied by a rule on the line number, so that a count of rows isn't a
#: count of values.
_EMPTY = {"Description": 3, "Quantity": 5}
_INVOICE_SQL = {c: f"CASE WHEN l.l_linenumber <> {_EMPTY[c]} THEN 1 END" if c in _EMPTY else "1" for c in _INVOICE_COLS}


@register("group_nonnull_count", """
SELECT substr(strftime(l.l_shipdate, '%m/%d/%Y %H:%M'), 4, 1) AS key, """ + ", ".join(
    f'CAST(count({_INVOICE_SQL[c]}) AS BIGINT) AS "{c}"' for c in _INVOICE_COLS) + """
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1""")
def group_nonnull_count(spark, sf_dir):
    """Non-NULL count of every column per one-character key of the invoice
    date (its fourth character), over the Latin-1 invoice file."""
    from hazeline.plans.q_scans import INVOICE, LATIN1, invoices_csv
    from hazeline.sources import files
    inv = files.csv_typed(spark, invoices_csv(spark, sf_dir), INVOICE, encoding=LATIN1)
    inv = inv.withColumns({c: F.when(F.col("LineNo") != n, F.col(c)) for c, n in _EMPTY.items()})
    keyed = inv.select(F.substring("InvoiceDate", 4, 1).alias("key"), *_INVOICE_COLS)
    return agg.nonnull_count_by(keyed, ["key"])


_RANGE = ", ".join(f"""{rounded(f'min("{m}")')} AS "min_{m}", {rounded(f'max("{m}")')} AS "max_{m}\"""" for m in MEASURES)


@register("measure_range", with_(BASE, f"SELECT {_RANGE} FROM ({DISTRICT_MEAN_SQL}) d"))
def measure_range(spark, sf_dir):
    """Min and max of each measure over the district mean table (a shared
    colour scale for the maps)."""
    return show(agg.measure_range(district_mean_table(spark, sf_dir), MEASURES))


@register("measure_range_cleaned", with_(CLEAN, f"SELECT {_RANGE} FROM clean"))
def measure_range_cleaned(spark, sf_dir):
    """Min and max of each measure over the cleaned readings themselves."""
    return show(agg.measure_range(cleaned(spark, sf_dir), MEASURES))


_NN = " AND ".join(f"{k} IS NOT NULL" for k in STATION_KEYS + ["year"])


@register("measure_range_by_year", with_(CLEAN, f"""
SELECT year, {_RANGE} FROM (
  SELECT station, district, latitude, longitude, year, {means()} FROM clean WHERE {_NN}
  GROUP BY station, district, latitude, longitude, year) s GROUP BY year"""))
def measure_range_by_year(spark, sf_dir):
    """Min and max of each measure of every year's station map."""
    return show(agg.measure_range(pipelines.station_year_means(cleaned(spark, sf_dir)), MEASURES, ["year"]))


HIST_BINS = 10


_HIST_CTES = [
    'r AS (SELECT min("SO2") AS lo, max("SO2") AS hi FROM silver)',
    f"""b AS (SELECT CAST(least(coalesce(floor(("SO2" - lo) / ((hi - lo) / {float(HIST_BINS)})), 0),
        {HIST_BINS - 1}) AS INTEGER) AS bin, lo, (hi - lo) / {float(HIST_BINS)} AS width
      FROM silver, r WHERE "SO2" IS NOT NULL)"""]


@register("histogram_bins", with_(BASE + _HIST_CTES, """
SELECT bin, lo + bin * width AS bin_lo, lo + (bin + 1) * width AS bin_hi, count(*) AS n
FROM b GROUP BY bin, lo, width"""))
def histogram_bins(spark, sf_dir):
    return agg.histogram(readings(spark, sf_dir), "SO2", HIST_BINS)


def bike_daily(spark, sf_dir):
    """Daily mean of the second series; text columns dropped first."""
    from hazeline.functions import dmy_to_date
    b = bike_days(spark, sf_dir).drop("Seasons", "Holiday", "Functioning Day")
    b = b.select(dmy_to_date("Date").alias("Date"), *[c for c in b.columns if c != "Date"])
    return agg.mean_all_numeric(b, ["Date"])
