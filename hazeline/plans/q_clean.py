"""Cleaning queries: the outlier band and the station-year mean (flagship)."""

from __future__ import annotations

from hazeline.pipelines import station_year_means
from hazeline.plans.catalog import register
from hazeline.plans.common import STATION_KEYS, cleaned, readings, show
from hazeline.plans.oracle import BASE, CLEAN, out_means, with_
from hazeline.schemas import MEASURES

_NN = " AND ".join(f"{k} IS NOT NULL" for k in STATION_KEYS + ["year"])
_STATION_YEAR = f"""
SELECT station, district, latitude, longitude, year, {out_means()}
FROM clean WHERE {_NN}
GROUP BY station, district, latitude, longitude, year"""


@register("station_year_mean", with_(CLEAN, _STATION_YEAR))
def station_year_mean(spark, sf_dir):
    """Yearly mean per station after outlier removal: one group-by over all
    years instead of one filter and one job per year."""
    return show(station_year_means(cleaned(spark, sf_dir)), MEASURES)


@register("station_year_mean_uncleaned", with_(BASE, _STATION_YEAR.replace("FROM clean", "FROM silver")))
def station_year_mean_uncleaned(spark, sf_dir):
    """Yearly mean per station over all readings, without the outlier band."""
    return show(station_year_means(readings(spark, sf_dir)), MEASURES)
