"""Sinks: one folder per year keeps NULL years; latest-per-day re-runs are
idempotent and leave other days alone."""

from pyspark.sql import functions as F

from hazeline import sinks
from hazeline.sources.inline import inline_rows
from hazeline.streaming import snapshots as snap


def test_year_partitioned_sink_keeps_everything(spark, tmp_path):
    df = inline_rows(spark, [(1, 2016, 1.0), (2, 2017, 2.0), (3, None, 3.0)],
                     "id int, year int, v double")
    path = str(tmp_path / "by_year")
    sinks.year_partitioned_sink(df, path, fmt="parquet")
    back = spark.read.parquet(path)
    assert sorted((r.id, r.year) for r in back.collect()) == [(1, 2016), (2, 2017), (3, None)]
    plan = back.filter(F.col("year") == 2017)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def _flat(spark, rows):
    return inline_rows(spark, rows, "idx int, obs_local string, sync string, aqi int")


def test_daily_latest_idempotent(spark, tmp_path):
    path = str(tmp_path / "daily")
    day1 = _flat(spark, [(1, "2024-08-25 00:00:00", "2024-08-25T00:10:00+09:00", 91),
                         (1, "2024-08-25 00:00:00", "2024-08-25T00:40:00+09:00", 93),
                         (1, "2024-08-26 05:00:00", "2024-08-26T05:10:00+09:00", 40)])
    snap.write_daily_latest(day1, path)
    # Re-run of 2024-08-25 only, with a later revision: that day is replaced,
    # 2024-08-26 stays.
    snap.write_daily_latest(
        _flat(spark, [(1, "2024-08-25 03:00:00", "2024-08-25T03:20:00+09:00", 77)]), path)
    got = {(str(r.date), r.idx): r.aqi for r in spark.read.parquet(path).collect()}
    assert got == {("2024-08-25", 1): 77, ("2024-08-26", 1): 40}


def test_daily_latest_keeps_other_stations_and_newer_revisions(spark, tmp_path):
    path = str(tmp_path / "daily")
    snap.write_daily_latest(_flat(spark, [(1, "2024-08-25 00:00:00", "2024-08-25T00:40:00+09:00", 93),
                                          (2, "2024-08-25 00:00:00", "2024-08-25T00:41:00+09:00", 50)]), path)
    later = _flat(spark, [(1, "2024-08-25 02:00:00", "2024-08-25T02:40:00+09:00", 95)])
    older = _flat(spark, [(2, "2024-08-25 00:00:00", "2024-08-25T00:01:00+09:00", 1)])
    for batch in (later, older, later):
        snap.write_daily_latest(batch, path)
    assert {r.idx: r.aqi for r in spark.read.parquet(path).collect()} == {1: 95, 2: 50}


def test_geojson_of_many_features_round_trips(spark, tmp_path):
    from hazeline.sources import files
    path = str(tmp_path / "geo")
    rows = spark.range(200_000).select(
        F.concat(F.lit("d"), F.col("id")).alias("SIG_ENG_NM"),
        F.struct(F.lit("Polygon").alias("type"), F.concat(F.lit("[["), F.col("id"), F.lit(",1]]")).alias("coordinates")).alias("geometry"))
    files.write_geojson(rows, path)
    back = files.geojson_features(spark, path)
    assert back.count() == 200_000 and back.select("SIG_ENG_NM").distinct().count() == 200_000
    assert back.where("SIG_ENG_NM = 'd77'").first().geometry.coordinates.replace(" ", "") == "[[77,1]]"
    assert len([p for p in (tmp_path / "geo").iterdir() if p.name.startswith("part-")]) >= 20
    files.write_geojson(rows.limit(0), str(tmp_path / "none"))
    assert files.geojson_features(spark, str(tmp_path / "none")).count() == 0
