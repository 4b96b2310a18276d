"""Latest revision of a snapshot: batch and stream, either file order."""

import json
import os
import tempfile
import time

import pytest

from hazeline.sources import files
from hazeline.streaming import snapshots as snap


def _doc(aqi, sync, co, hour="2031-03-25 00:00:00", idx=7001):
    d = hour[:10]
    return {"status": "ok", "data": {
        "aqi": aqi, "idx": idx, "dominentpol": "pm25", "attributions": [],
        "city": {"geo": [37.5, 127.0], "name": "Metro City", "url": "u", "location": ""},
        "iaqi": {"co": {"v": co}, "pm25": {"v": aqi}, "t": {"v": 26}},
        "time": {"s": hour, "tz": "+09:00", "v": 1931472000,
                 "iso": f"{d}T{hour[11:]}+09:00"},
        "forecast": {"daily": {"o3": [{"avg": 1, "day": d, "max": 2, "min": 0}],
                               "pm10": [], "pm25": [], "uvi": []}},
        "debug": {"sync": sync}}}


def _write(folder, name, doc, mtime):
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write(json.dumps(doc) + "\n")
    os.utime(p, (mtime, mtime))


OLD = _doc(51, "2031-03-25T00:10:00+09:00", 2)
NEW = _doc(58, "2031-03-25T00:40:00+09:00", 2.75)


@pytest.mark.parametrize("newer_first", [True, False])
def test_batch_latest_wins(spark, newer_first):
    d = tempfile.mkdtemp(prefix="hz-snap-")
    now = time.time()
    first, second = (NEW, OLD) if newer_first else (OLD, NEW)
    _write(d, "a.json", first, now - 100)
    _write(d, "b.json", second, now - 50)
    flat = snap.flatten(files.snapshots(spark, d))
    co = sorted(r.co for r in flat.collect())
    assert co == [2.0, 2.75]                              # integer and decimal both DOUBLE
    out = snap.latest(flat, ["idx", "obs_epoch"]).collect()
    assert len(out) == 1 and out[0].aqi == 58


@pytest.mark.parametrize("newer_first", [True, False])
def test_stream_equals_batch(spark, newer_first):
    src = tempfile.mkdtemp(prefix="hz-stream-src-")
    run = tempfile.mkdtemp(prefix="hz-stream-run-")
    now = time.time()
    first, second = (NEW, OLD) if newer_first else (OLD, NEW)
    _write(src, "a.json", first, now - 100)
    _write(src, "b.json", second, now - 50)
    _write(src, "c.json", _doc(40, "2031-03-25T01:05:00+09:00", 3, hour="2031-03-25 01:00:00"),
           now - 10)
    snap.stream_latest(spark, src, f"{run}/out", f"{run}/ckpt", max_files_per_trigger=1)
    got = {(r.idx, r.window_epoch): r.aqi for r in snap.read_stream_result(spark, f"{run}/out").collect()}
    batch = snap.latest(snap.flatten(files.snapshots(spark, src)), ["idx", "obs_epoch"]).collect()
    want = {(r.idx, r.obs_epoch): r.aqi for r in batch}
    assert got == want
    assert sorted(got.values()) == [40, 58]


@pytest.mark.parametrize("backwards", [True, False])
def test_stream_over_distant_days_equals_batch(spark, backwards):
    """One file per micro-batch, days far apart, in either order: nothing is
    dropped for being late."""
    src = tempfile.mkdtemp(prefix="hz-days-src-")
    run = tempfile.mkdtemp(prefix="hz-days-run-")
    days = ["2031-03-01", "2031-03-05", "2031-03-11", "2031-03-20"]
    now = time.time()
    for k, day in enumerate(reversed(days) if backwards else days):
        _write(src, f"{k}.json", _doc(10 + k, f"{day}T00:30:00+09:00", 1, hour=f"{day} 00:00:00"), now - 100 + k)
    snap.stream_latest(spark, src, f"{run}/out", f"{run}/ckpt", max_files_per_trigger=1)
    got = {(r.idx, r.window_epoch): r.aqi for r in snap.read_stream_result(spark, f"{run}/out").collect()}
    batch = snap.latest(snap.flatten(files.snapshots(spark, src)), ["idx", "obs_epoch"]).collect()
    assert got == {(r.idx, r.obs_epoch): r.aqi for r in batch} and len(got) == 4


def test_unreadable_times(spark):
    """A malformed observation time doesn't fail the job; a revision without a
    sync time keeps its values and loses to one that has a later time."""
    d = tempfile.mkdtemp(prefix="hz-bad-")
    now = time.time()
    _write(d, "a.json", _doc(30, None, 1), now - 20)
    _write(d, "b.json", _doc(31, "not a time", 1, hour="2031-03-25 01:00:00"), now - 15)
    bad = _doc(32, "2031-03-25T02:10:00+09:00", 1)
    bad["data"]["time"]["iso"] = "yesterday"
    _write(d, "c.json", bad, now - 10)
    flat = snap.flatten(files.snapshots(spark, d))
    out = {r.obs_epoch: r.aqi for r in snap.latest(flat, ["idx", "obs_epoch"]).collect()}
    assert sorted(out.values()) == [30, 31, 32] and None in out
    assert tuple(snap.rejects(flat).first()) == (3, 1, 2)


def test_stream_restart_keeps_state(spark):
    """Stop after the first files, restart from the same checkpoint when a
    later revision arrives: state carries over, old files are not re-read."""
    src = tempfile.mkdtemp(prefix="hz-restart-src-")
    run = tempfile.mkdtemp(prefix="hz-restart-run-")
    now = time.time()
    _write(src, "a.json", OLD, now - 100)
    snap.stream_latest(spark, src, f"{run}/out", f"{run}/ckpt")
    first = {r.idx: r.aqi for r in snap.read_stream_result(spark, f"{run}/out").collect()}
    assert first == {7001: 51}
    _write(src, "b.json", NEW, now - 50)
    snap.stream_latest(spark, src, f"{run}/out", f"{run}/ckpt")
    second = {r.idx: r.aqi for r in snap.read_stream_result(spark, f"{run}/out").collect()}
    assert second == {7001: 58}
    # An older revision arriving after the newer one does not win.
    _write(src, "c.json", _doc(49, "2031-03-25T00:05:00+09:00", 2), now - 10)
    snap.stream_latest(spark, src, f"{run}/out", f"{run}/ckpt")
    third = {r.idx: r.aqi for r in snap.read_stream_result(spark, f"{run}/out").collect()}
    assert third == {7001: 58}


def test_latest_orders_by_instant_not_text(spark):
    # 01:00+09:00 is 16:00 UTC the day before; 20:00+00:00 the same day is
    # later in time although it sorts earlier as text.
    d = tempfile.mkdtemp(prefix="hz-offset-")
    now = time.time()
    _write(d, "a.json", _doc(50, "2031-03-25T01:00:00+09:00", 1), now - 20)
    _write(d, "b.json", _doc(60, "2031-03-24T20:00:00+00:00", 1), now - 10)
    flat = snap.flatten(files.snapshots(spark, d))
    out = snap.latest(flat, ["idx", "obs_epoch"]).collect()
    assert len(out) == 1 and out[0].aqi == 60
