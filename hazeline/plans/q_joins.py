"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import joins
from hazeline.operators.aggregates import mean_by
from hazeline.plans.catalog import register
from hazeline.plans.common import STATION_KEYS, readings, show
from hazeline.plans.oracle import BASE, CLEAN, mean, out_means, rounded, with_
from hazeline.plans.q_aggregates import bike_daily
from hazeline.schemas import MEASURES
from hazeline.sources.adapter import boundaries
from hazeline.sources.tables import table

_NN = " AND ".join(f"{k} IS NOT NULL" for k in STATION_KEYS + ["year"])
_SYM = f"""sym AS (SELECT station, district, latitude, longitude, year, {out_means()}
  FROM clean WHERE {_NN} GROUP BY station, district, latitude, longitude, year)"""
_GEO = """geo AS (SELECT n_name AS "SIG_ENG_NM", 'Polygon' AS geometry_type,
  printf('[[%d, %d]]', n_nationkey, n_regionkey) AS geometry_coordinates FROM nation)"""


@register("boundary_join", with_(CLEAN + [_SYM, _GEO], """
SELECT geo.*, sym.* EXCLUDE (district) FROM geo JOIN sym ON geo."SIG_ENG_NM" = sym.district"""))
def boundary_join(spark, sf_dir):
    """Boundaries joined to station-year means (aggregate first, then join);
    the geometry payload is carried through untouched."""
    from hazeline.plans.q_clean import station_year_mean
    b = boundaries(spark, sf_dir).select(
        "SIG_ENG_NM", F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("geometry_coordinates"))
    return joins.boundary_join(b, "SIG_ENG_NM", station_year_mean(spark, sf_dir), "district")


@register("boundary_join_uncleaned", with_(BASE + [_SYM.replace("FROM clean", "FROM silver"), _GEO], """
SELECT geo.*, sym.* EXCLUDE (district) FROM geo JOIN sym ON geo."SIG_ENG_NM" = sym.district"""))
def boundary_join_uncleaned(spark, sf_dir):
    """The map table over all readings, without the outlier band."""
    from hazeline.plans.q_clean import station_year_mean_uncleaned
    b = boundaries(spark, sf_dir).select(
        "SIG_ENG_NM", F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("geometry_coordinates"))
    return joins.boundary_join(b, "SIG_ENG_NM", station_year_mean_uncleaned(spark, sf_dir), "district")


_BIKE_COLS = ["Rented Bike Count", "Hour", "Temperature"]
_BIKE = f"""bike AS (SELECT CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS "Date",
  o_totalprice AS "Rented Bike Count", CAST(o_custkey AS DOUBLE) AS "Hour",
  CAST(o_orderkey AS DOUBLE) AS "Temperature" FROM orders),
bike_d AS (SELECT "Date", {", ".join(f'{rounded(mean(c))} AS "{c}"' for c in _BIKE_COLS)}
  FROM bike WHERE "Date" IS NOT NULL GROUP BY "Date")"""
_DAILY = f"daily AS (SELECT day, {out_means()} FROM silver WHERE day IS NOT NULL GROUP BY day)"


def _daily(spark, sf_dir):
    return mean_by(readings(spark, sf_dir), ["day"], MEASURES)


@register("daily_series_join", with_(BASE + [_BIKE, _DAILY], """
SELECT bike_d.*, daily.* FROM bike_d JOIN daily ON bike_d."Date" = daily.day"""))
def daily_series_join(spark, sf_dir):
    """Daily second series joined to daily reading means on the date; both
    sides are aggregated before the join."""
    return show(joins.series_join(bike_daily(spark, sf_dir), "Date", _daily(spark, sf_dir), "day"))


@register("row_aligned_join", with_(BASE + [_BIKE, _DAILY, """
a AS (SELECT *, row_number() OVER (ORDER BY "Date") - 1 AS ordinal FROM bike_d)""", """
b AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS ordinal FROM daily)"""], """
SELECT a.*, b.* EXCLUDE (ordinal) FROM a JOIN b USING (ordinal)"""))
def row_aligned_join(spark, sf_dir):
    """Row-position concatenation of the two daily series (each in date
    order), inner on position."""
    return show(joins.row_aligned_join(bike_daily(spark, sf_dir), "Date", _daily(spark, sf_dir), "day"))


@register("asof_last_view", """
SELECT e.event_id, e.user_id, e.ts, e.event_type, v.view_id, v.view_ts, v.view_value FROM events e ASOF LEFT JOIN (
  SELECT user_id, ts AS view_ts, max(event_id) AS view_id, arg_max(value, event_id) AS view_value
  FROM events WHERE event_type = 'view' GROUP BY user_id, ts) v
ON e.user_id = v.user_id AND e.ts >= v.view_ts""")
def asof_last_view(spark, sf_dir):
    """Every event with its user's last view at or before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    views = events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return joins.asof_join(events.drop("value"), views, "ts", "view_ts", ["view_id", "view_ts", "view_value"],
                           on=["user_id"], ties=["view_id"])


@register("asof_order_before", with_(BASE, """
SELECT s.reading_id, s.measured_at, CASE WHEN near THEN o_orderkey END AS o_orderkey,
  CASE WHEN near THEN o_totalprice END AS o_totalprice FROM (
  SELECT s.reading_id, s.measured_at, o.*, s.measured_at <= o.o_orderdate + INTERVAL 1 DAY AS near
  FROM silver s ASOF LEFT JOIN (
    SELECT o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
    FROM orders GROUP BY o_orderdate) o ON s.measured_at > o.o_orderdate) s"""))
def asof_order_before(spark, sf_dir):
    """Every reading with the last order before it, of no key at all, if it was
    placed within a day: one key holds all rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    own = readings(spark, sf_dir).select("reading_id", "measured_at")
    return joins.asof_join(own, orders, "measured_at", "o_orderdate", ["o_orderkey", "o_totalprice"],
                           ties=["o_orderkey"], strict=True, within=86_400_000_000)


_MINUTES = "to_microseconds(CAST(floor(value * 60) AS BIGINT) * 1000000)"


@register("interval_events", f"""
SELECT e.event_id, e.user_id, e.ts, p.purchase_id, p.until FROM events e JOIN (
  SELECT event_id AS purchase_id, user_id, ts, ts + {_MINUTES} AS until FROM events WHERE event_type = 'purchase') p
ON e.user_id = p.user_id AND e.ts >= p.ts AND e.ts < p.until""")
def interval_events(spark, sf_dir):
    """Events within as many minutes behind a purchase of their user as it cost:
    intervals from seconds to hours."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    until = F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 60))
    held = events.where("event_type = 'purchase'").select(
        "user_id", "ts", until.alias("until"), F.col("event_id").alias("purchase_id"))
    return joins.interval_join(events.drop("event_type", "value"), held, "ts", "ts", "until", ["purchase_id", "until"], on=["user_id"])


_OPEN = """open AS (SELECT o_orderkey, o_custkey, o_orderdate, max(l_shipdate) AS shipped
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""


def _open_orders(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(shipped, "o_orderkey")


@register("interval_open_orders", f"""WITH {_OPEN}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, b.o_orderkey AS open_key, b.shipped AS open_until
FROM orders o JOIN open b ON o.o_custkey = b.o_custkey AND o.o_orderdate >= b.o_orderdate AND o.o_orderdate < b.shipped""")
def interval_open_orders(spark, sf_dir):
    """Orders placed while an order of the same customer was open."""
    held = _open_orders(spark, sf_dir).withColumnsRenamed({"o_orderkey": "open_key", "shipped": "open_until"})
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.interval_join(placed, held, "o_orderdate", "o_orderdate", "open_until", ["open_key", "open_until"], on=["o_custkey"])


@register("overlap_open_orders", f"""WITH {_OPEN}
SELECT a.*, b.o_orderkey AS other_key FROM open a JOIN open b
ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
  AND greatest(a.o_orderdate, b.o_orderdate) < least(a.shipped, b.shipped)
  AND a.o_orderdate < a.shipped AND b.o_orderdate < b.shipped""")
def overlap_open_orders(spark, sf_dir):
    """Pairs of a customer's orders that were open at one time."""
    own = _open_orders(spark, sf_dir)
    other = own.withColumnsRenamed({"o_orderkey": "other_key"})
    bounds = ("o_orderdate", "shipped")
    return joins.overlap_join(own, other, bounds, bounds, ["other_key"], on=["o_custkey"]).where("o_orderkey <> other_key")
