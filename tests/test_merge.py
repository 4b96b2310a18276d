"""Merging revisions into a stored table: no stored row is ever lost."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from hazeline.sources import fs
from hazeline.sources.inline import inline_rows
from hazeline.streaming import snapshots as snap

SCHEMA = "idx int, obs_local string, aqi int, dominentpol string, sync string"


def polls(spark, *rows):
    """(station, day, aqi, revision) as flat rows."""
    return inline_rows(spark, [(i, d and f"{d} 10:00:00", a, "o3", f"2024-05-09T{h:02d}:00:00+00:00") for i, d, a, h in rows], SCHEMA)


def stored(spark, path):
    return sorted(((r.date, r.idx, r.aqi) for r in snap.read_merged(spark, path).collect()), key=repr)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="hazeline-merge-") + "/table"


def test_older_and_repeated_merges_change_nothing(spark, path):
    snap.write_daily_latest(polls(spark, (1, "2024-05-01", 10, 5), (2, "2024-05-02", 20, 5)), path)
    for _ in range(2):
        snap.write_daily_latest(polls(spark, (1, "2024-05-01", 11, 4), (3, "2024-05-01", 30, 1)), path)
    assert stored(spark, path) == [("2024-05-01", 1, 10), ("2024-05-01", 3, 30), ("2024-05-02", 2, 20)]


def test_a_table_without_a_column_keeps_its_rows(spark, path):
    snap.write_daily_latest(polls(spark, (1, "2024-05-01", 10, 5)).drop("dominentpol"), path)
    snap.write_daily_latest(polls(spark, (2, "2024-05-01", 20, 5)), path)
    assert stored(spark, path) == [("2024-05-01", 1, 10), ("2024-05-01", 2, 20)]
    kinds = {r.idx: r.dominentpol for r in snap.read_merged(spark, path).collect()}
    assert kinds == {1: None, 2: "o3"}
    # And the other way round, with files of both kinds in the table.
    snap.write_daily_latest(polls(spark, (3, "2024-05-01", 30, 5), (4, "2024-05-02", 40, 5)).drop("dominentpol"), path)
    assert {r.idx: r.dominentpol for r in snap.read_merged(spark, path).collect()} == {1: None, 2: "o3", 3: None, 4: None}


def test_a_column_that_only_the_table_has_is_kept(spark, path):
    (polls(spark, (1, "2024-05-01", 10, 5)).withColumn("date", F.lit("2024-05-01")).withColumn("note", F.lit("x"))
     .write.partitionBy("date").parquet(path))
    snap.write_daily_latest(polls(spark, (2, "2024-05-01", 20, 5)), path)
    assert {r.idx: r.note for r in snap.read_merged(spark, path).collect()} == {1: "x", 2: None}


def test_an_unreadable_table_is_an_error(spark, path):
    os.makedirs(f"{path}/date=2024-05-01")
    with open(f"{path}/date=2024-05-01/part-0.parquet", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception, match="parquet|PARQUET|Parquet|FAILED_READ"):
        snap.write_daily_latest(polls(spark, (2, "2024-05-01", 20, 5)), path)
    assert os.path.exists(f"{path}/date=2024-05-01/part-0.parquet")


def test_null_dates_and_stations_are_merged(spark, path):
    snap.write_daily_latest(polls(spark, (1, None, 10, 5), (None, "2024-05-01", 5, 5)), path)
    snap.write_daily_latest(polls(spark, (2, None, 20, 5), (None, "2024-05-01", 6, 6)), path)
    assert stored(spark, path) == [("2024-05-01", None, 6), (None, 1, 10), (None, 2, 20)]


def test_a_driver_lost_while_dates_are_replaced_loses_nothing(spark, path, monkeypatch):
    snap.write_daily_latest(polls(spark, (1, "2024-05-01", 10, 5), (2, "2024-05-02", 20, 5)), path)

    def lost(spark, path, staged, date):
        shutil.rmtree(f"{path}/date=2024-05-01")
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(snap, "_install", lost)
        with pytest.raises(RuntimeError):
            snap.write_daily_latest(polls(spark, (3, "2024-05-01", 30, 5)), path)
    assert stored(spark, path) == [("2024-05-02", 2, 20)]
    assert fs.read_marker(spark, f"{path}/_merging")
    snap.write_daily_latest(polls(spark, (4, "2024-05-03", 40, 5)), path)
    assert stored(spark, path) == [("2024-05-01", 1, 10), ("2024-05-01", 3, 30), ("2024-05-02", 2, 20), ("2024-05-03", 4, 40)]
    assert not snap.recover(spark, path)
