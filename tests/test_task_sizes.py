"""What one task reads or writes is bounded, however large the input."""

import datetime
import glob
import os

from pyspark.sql import functions as F

from hazeline.plans import q_scans, q_streams
from hazeline.sources import adapter, files, landing

SF0001 = "/root/testdata/sf0.001"


def _files(path, end):
    return glob.glob(f"{path.removeprefix('file:')}/**/*{end}", recursive=True)


def test_a_large_year_of_silver_is_split(spark, tmp_path, monkeypatch):
    bronze = f"{tmp_path}/bronze"
    landing.bronze(spark, SF0001).repartition(8).write.parquet(bronze)
    monkeypatch.setattr(landing, "land_bronze", lambda *_: bronze)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "24k")
    try:
        path = landing.land_silver(spark, SF0001, force=True)
    finally:
        spark.conf.set(key, old)
    years = {}
    for f in _files(path, ".parquet"):
        years.setdefault(os.path.dirname(f), []).append(f)
    assert max(map(len, years.values())) > 1
    assert spark.read.parquet(path).count() == adapter.raw_readings(spark, SF0001).count()


def test_readings_csv_is_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 500)
    path = landing.derived(spark, SF0001, "readings_csv_bounded", lambda p: files.write_csv(
        q_scans.raw(spark, SF0001), p, compressed=True))
    back = files.csv_text(spark, path)
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == q_scans.raw(spark, SF0001).count()
    assert _files(q_scans.readings_csv(spark, SF0001), ".csv.gz") and not _files(q_scans.readings_csv(spark, SF0001), ".csv")


def test_events_are_dealt_and_documents_written_compressed(spark, monkeypatch):
    seen = []

    def deal(e):
        seen.append(e.columns)
        return e.repartition(3, "date").sortWithinPartitions("date")
    plain = adapter.snapshot_documents(spark, SF0001)
    dealt = adapter.snapshot_documents(spark, SF0001, deal)
    assert dealt.schema == plain.schema and "data" not in seen[0]
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    monkeypatch.setattr(q_streams, "DOCUMENT_FILE_BYTES", 10_000)
    path = q_streams.snapshot_dir(spark, SF0001, force=True)
    found = _files(path, ".json.gz")
    assert not _files(path, ".json") and max(sum(os.path.dirname(f) == d for f in found) for d in map(os.path.dirname, found)) > 1
    assert spark.read.json(path).count() == plain.count()


def test_batches_of_events_do_not_grow_with_their_files(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, t + datetime.timedelta(minutes=i), i % 5, ("view", "purchase")[i % 2], 1.0, "{}") for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    path, _ = q_streams._event_files(spark, str(tmp_path))
    assert len(_files(path, ".parquet")) <= q_streams.ARRIVALS + 1 + 2
    assert spark.read.parquet(path).where("event_id is not null").count() == 400
