"""Window queries: running values, ranks, moving frames and sessions
over keys of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import scans
from hazeline.operators.sessions import sessions
from hazeline.plans.catalog import register
from hazeline.sources.tables import table

_CENTS = "CAST(value AS DECIMAL(18, 2))"
_BY_USER = "(PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


@register("running_totals", f"""
SELECT event_id, user_id, ts, event_type, value, count(*) OVER w AS n_so_far,
  CAST(sum({_CENTS}) OVER w AS DOUBLE) AS total_so_far, max(value) OVER w AS most_so_far,
  last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER w AS last_view
FROM events WINDOW w AS {_BY_USER}""")
def running_totals(spark, sf_dir):
    """Count, sum, maximum and last view of each user's events so far."""
    out = scans.running(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {
        "n_so_far": ("count", F.lit(1)), "total_so_far": ("sum", F.col("value").cast("decimal(18,2)")),
        "most_so_far": ("max", F.col("value")), "last_view": ("last", F.when(F.col("event_type") == "view", F.col("event_id")))})
    return out.withColumn("total_so_far", F.col("total_so_far").cast("double"))


@register("running_total_of_all", f"""
SELECT event_id, ts, CAST(sum({_CENTS}) OVER w AS DOUBLE) AS total_before, min(value) OVER w AS least_before
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_total_of_all(spark, sf_dir):
    """Sum and minimum of all events before each: one key holds all rows."""
    out = scans.running(_events(spark, sf_dir).select("event_id", "ts", "value"), [], ["ts", "event_id"], {
        "total_before": ("sum", F.col("value").cast("decimal(18,2)")), "least_before": ("min", F.col("value"))}, before=True)
    return out.select("event_id", "ts", F.col("total_before").cast("double").alias("total_before"), "least_before")


@register("event_ranks", """
SELECT event_id, event_type, value, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value DESC)""")
def event_ranks(spark, sf_dir):
    """Ranks by value within the five event types, with ties."""
    return scans.ranked(_events(spark, sf_dir).select("event_id", "event_type", "value"), ["event_type"], ["value desc"]).drop("row_number")


@register("moving_frames", f"""
SELECT event_id, user_id, ts, value, CAST(sum({_CENTS}) OVER w AS DOUBLE) AS sum_9, min(value) OVER w AS min_9,
  max(value) OVER w AS max_9, count(*) OVER w AS n_9
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 2 FOLLOWING)""")
def moving_frames(spark, sf_dir):
    """Sum, minimum, maximum and count over six events before and two after."""
    out = scans.moving(_events(spark, sf_dir).drop("event_type"), ["user_id"], ["ts", "event_id"], {
        "sum_9": (F.sum, F.col("value").cast("decimal(18,2)")), "min_9": (F.min, F.col("value")),
        "max_9": (F.max, F.col("value")), "n_9": (F.count, F.lit(1))}, preceding=6, following=2)
    return out.withColumn("sum_9", F.col("sum_9").cast("double"))


def session_sql(keys: str, gap_seconds: int) -> str:
    """Sessions by the time of the row before."""
    own = f"PARTITION BY {keys} " if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""WITH a AS (
  SELECT *, coalesce(ts > lag(ts) OVER ({own}ORDER BY ts) + INTERVAL {gap_seconds} SECOND, true) AS begins FROM events),
b AS (SELECT *, sum(begins::INT) OVER ({own}ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM a)
SELECT {lead}min(ts) AS session_start, max(ts) + INTERVAL {gap_seconds} SECOND AS session_end, count(*) AS n_rows,
  CAST(sum({_CENTS}) AS DOUBLE) AS total FROM b GROUP BY {lead}session"""


def total():
    """Values of a session, exact to the cent."""
    return {"total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}


@register("event_sessions", session_sql("user_id", 7200))
def event_sessions(spark, sf_dir):
    """Sessions of each user's events, two hours apart."""
    return sessions(_events(spark, sf_dir), ["user_id"], "ts", 7200, total())


@register("all_sessions", session_sql("", 600))
def all_sessions(spark, sf_dir):
    """Sessions of all events together, ten minutes apart: one key holds all."""
    return sessions(_events(spark, sf_dir), [], "ts", 600, total())
