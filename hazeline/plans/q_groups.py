"""Queries by group: imputation, rollup and cube, bag operations,
distinct counts and top k (2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.functions.safe import rounded as nice
from hazeline.operators import bags, distinct, lattice, topk
from hazeline.operators.groupstats import impute, quantiles
from hazeline.plans.catalog import register
from hazeline.plans.common import readings, show
from hazeline.plans.oracle import BASE, rounded, with_
from hazeline.session import written
from hazeline.sources.tables import table

_GAPS = ["SO2", "NO2", "PM10"]


def _filled_sql(stat: str) -> str:
    """Readings with the gaps filled from a table g of a statistic by district."""
    return with_(BASE + [stat], "SELECT reading_id, s.district, " + ", ".join(
        f"{rounded(f'coalesce(s.{chr(34)}{c}{chr(34)}, g.{chr(34)}{c}{chr(34)})')} AS \"{c}\"" for c in _GAPS) +
        " FROM silver s LEFT JOIN g ON s.district IS NOT DISTINCT FROM g.district")


def _of_each(fn: str) -> str:
    return "g AS (SELECT district, " + ", ".join(fn.format(f'"{c}"') + f' AS "{c}"' for c in _GAPS) + " FROM silver GROUP BY district)"


_MODES = "g AS (SELECT d.district, " + ", ".join(f'm{i}.v AS "{c}"' for i, c in enumerate(_GAPS)) + " FROM (SELECT DISTINCT district FROM silver) d " + " ".join(
    f"""LEFT JOIN (SELECT district, "{c}" AS v FROM silver WHERE "{c}" IS NOT NULL GROUP BY district, "{c}"
  QUALIFY row_number() OVER (PARTITION BY district ORDER BY count(*) DESC, "{c}") = 1) m{i} ON d.district IS NOT DISTINCT FROM m{i}.district"""
    for i, c in enumerate(_GAPS)) + ")"


def _filled(spark, sf_dir, how):
    return show(impute(readings(spark, sf_dir).select("reading_id", "district", *_GAPS), ["district"], _GAPS, how), _GAPS)


@register("impute_mean", _filled_sql(_of_each("avg({})")))
def impute_mean(spark, sf_dir):
    """Missing measures replaced by the mean of their district."""
    return _filled(spark, sf_dir, "mean")


@register("impute_median", _filled_sql(_of_each("quantile_cont({}, 0.5)")))
def impute_median(spark, sf_dir):
    """Missing measures replaced by the exact median of their district."""
    return _filled(spark, sf_dir, "median")


@register("impute_mode", _filled_sql(_MODES))
def impute_mode(spark, sf_dir):
    """Missing measures replaced by their district's most frequent value."""
    return _filled(spark, sf_dir, "mode")


@register("station_upper_quartiles", with_(BASE, "SELECT station, " + ", ".join(
    f'{rounded(f"quantile_cont({chr(34)}{c}{chr(34)}, 0.75)")} AS "{c}"' for c in _GAPS) + " FROM silver GROUP BY station"))
def station_upper_quartiles(spark, sf_dir):
    """Exact third quartiles of three measures for every station."""
    return show(quantiles(readings(spark, sf_dir).select("station", *_GAPS), ["station"], _GAPS, 0.75), _GAPS)


_LATTICE = ["district", "year", "month"]


def _lattice_sql(grouping: str) -> str:
    return with_(BASE, f"""
SELECT district, year, month, GROUPING(district, year, month) AS grouping_id, count(*) AS n_rows,
  count("PM10") AS "PM10_n", {rounded('sum("PM10")', 2)} AS "PM10_sum", {rounded('avg("PM10")', 3)} AS "PM10_mean",
  {rounded('stddev_samp("PM10")', 3)} AS "PM10_std", min("PM10") AS "PM10_min", max("PM10") AS "PM10_max"
FROM silver GROUP BY {grouping} (district, year, month)""")


def _told(df):
    return df.withColumns({c: nice(f"`{c}`", n) for c, n in (("PM10_sum", 2), ("PM10_mean", 3), ("PM10_std", 3))})


@register("cube_measure", _lattice_sql("CUBE"))
def cube_measure(spark, sf_dir):
    """PM10 by all subsets of district, year and month."""
    return _told(lattice.cube(readings(spark, sf_dir), _LATTICE, ["PM10"]))


@register("rollup_measure", _lattice_sql("ROLLUP"))
def rollup_measure(spark, sf_dir):
    """PM10 by district, year and month, with subtotals and a total."""
    return _told(lattice.rollup(readings(spark, sf_dir), _LATTICE, ["PM10"]))


def _days(spark, sf_dir, kind):
    """A row per event of a kind: who and on which day."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select("user_id", F.col("ts").cast("date").alias("day"))


_SIDES = """v AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase')"""


@register("bag_intersect", f"WITH {_SIDES} FROM v INTERSECT ALL FROM p")
def bag_intersect(spark, sf_dir):
    """Views that a purchase of their user and day can be paired with, one each."""
    return bags.intersect_all(_days(spark, sf_dir, "view"), _days(spark, sf_dir, "purchase"))


@register("bag_except", f"WITH {_SIDES} FROM v EXCEPT ALL FROM p")
def bag_except(spark, sf_dir):
    """Views that are left when each purchase takes one of its user and day."""
    return bags.except_all(_days(spark, sf_dir, "view"), _days(spark, sf_dir, "purchase"))


@register("bag_changes", f"""WITH {_SIDES},
m AS (SELECT user_id, day, sum(o)::BIGINT AS o, sum(n)::BIGINT AS n FROM (
  SELECT *, 1 AS o, 0 AS n FROM v UNION ALL SELECT *, 0, 1 FROM p) GROUP BY ALL),
k AS (SELECT user_id, sum(o)::BIGINT AS n_old, sum(n)::BIGINT AS n_new, sum(least(o, n))::BIGINT AS n_same FROM m GROUP BY user_id)
SELECT *, CASE WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed'
  WHEN n_same = n_old AND n_same = n_new THEN 'same' ELSE 'changed' END AS change FROM k""")
def bag_changes(spark, sf_dir):
    """How each user's days of views differ from those of purchases."""
    return bags.changes(_days(spark, sf_dir, "view"), _days(spark, sf_dir, "purchase"), ["user_id"])


@register("distinct_users_by_week", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events),
u AS (SELECT DISTINCT user_id, CAST(unnest(range(day, day + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS until FROM d)
SELECT until, count(*) AS n_users, true AS estimate_within_4_errors FROM u GROUP BY until""")
def distinct_users_by_week(spark, sf_dir):
    """Different users of the seven days up to each day, from daily state: exactly
    from bitmaps, and whether the estimate from sketches lies within four standard
    errors of that."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    exact = distinct.trailing(written(distinct.bitmaps(events, ["day"], "user_id"), "bitmaps"), "day", 7)
    rough = distinct.trailing(written(distinct.sketches(events, ["day"], "user_id"), "sketches"), "day", 7)
    both = distinct.exact_counts(exact, ["until"]).join(distinct.estimates(rough, ["until"]), "until")
    off = F.abs(F.col("estimate") - F.col("n_distinct")) / F.col("n_distinct")
    return both.select("until", F.col("n_distinct").alias("n_users"),
                       (off <= 4 * distinct.standard_error()).alias("estimate_within_4_errors"))


@register("top_events", """
SELECT event_id, event_type, user_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 10""")
def top_events(spark, sf_dir):
    """The ten greatest events of each type; of equal ones the first."""
    own = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    return topk.top_k(own, ["event_type"], ["value desc", "event_id"], 10)


@register("top_quantities_with_ties", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
QUALIFY rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) <= 3""")
def top_quantities_with_ties(spark, sf_dir):
    """The lines of each supplier with the three greatest quantities, and all that
    are as great as the third."""
    own = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return topk.top_k(own, ["l_suppkey"], ["l_quantity desc"], 3, with_ties=True)
