"""Event-time streams against batch: any order of files within the lateness."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from hazeline.operators.sessions import sessions
from hazeline.sources.inline import inline_rows
from hazeline.streaming import events as ev

T0 = dt.datetime(2024, 5, 1)
SCHEMA = "id int, k string, ts timestamp, what string"


def rows(rng, n):
    return [(i, rng.choice(["hot", "hot", "b", None]), T0 + dt.timedelta(seconds=rng.randrange(20_000)),
             rng.choice(["view", "buy"])) for i in range(n)]


def feed(spark, data, files, seed):
    """A folder of event files in a random order of rows, and a closing one."""
    path = tempfile.mkdtemp(prefix="hazeline-events-")
    data = data[:]
    random.Random(seed).shuffle(data)
    for i in range(files):
        inline_rows(spark, data[i::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    ev.closing(inline_rows(spark, data, SCHEMA), "ts", 90_000, by=["what"], keys=["k"]).coalesce(1).write.mode("append").parquet(path)
    return path, lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_of_a_stream_in_any_order(spark, seed):
    data = rows(random.Random(5), 160)
    path, stream = feed(spark, data, 4, seed)
    q = ev.stream_sessions(stream(), ["k"], "ts", 300, "30000 seconds", path + "-out", path + "-check", {"ids": F.sum("id")})
    assert ev.dropped(q) == 0
    got = spark.read.parquet(path + "-out")
    wanted = sessions(inline_rows(spark, data, SCHEMA), ["k"], "ts", 300, {"ids": F.sum("id")})
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    # Started again, it gives nothing twice.
    ev.stream_sessions(stream(), ["k"], "ts", 300, "30000 seconds", path + "-out", path + "-check", {"ids": F.sum("id")})
    assert spark.read.parquet(path + "-out").count() == got.count()


def test_a_late_row_joins_two_sessions(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    path = tempfile.mkdtemp(prefix="hazeline-late-")
    first = [(1, "a", at(0), "view"), (2, "a", at(100), "view")]
    for part in (first, [(3, "a", at(50), "view")]):
        inline_rows(spark, part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    ev.closing(inline_rows(spark, first, SCHEMA), "ts", 9000).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    ev.stream_sessions(stream, ["k"], "ts", 60, "1 hour", path + "-out", path + "-check")
    out = spark.read.parquet(path + "-out").collect()
    assert [(r.session_start, r.session_end, r.n_rows) for r in out] == [(at(0), at(160), 3)]


def test_rows_beyond_the_lateness_are_counted(spark):
    path = tempfile.mkdtemp(prefix="hazeline-beyond-")
    for s in (0, 50_000, 100_000, 10):
        inline_rows(spark, [(s, "a", T0 + dt.timedelta(seconds=s), "view")], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    q = ev.stream_sessions(stream, ["k"], "ts", 60, "1 hour", path + "-out", path + "-check")
    assert ev.dropped(q) == 1


@pytest.mark.parametrize("seed", [3])
def test_matches_of_two_streams(spark, seed):
    data = rows(random.Random(9), 120)
    path, stream = feed(spark, data, 3, seed)
    bought = stream().where("what = 'buy'").select("k", F.col("ts").alias("at"), F.col("id").alias("buy_id"))
    ev.stream_match(stream().where("what = 'view'"), bought, ["k"], "ts", "at", 200, "30000 seconds", ["buy_id", "at"], path + "-out", path + "-check")
    got = spark.read.parquet(path + "-out").where("id is not null").collect()
    expected = []
    for i, k, t, what in data:
        if what == "view":
            hits = [x for x in data if x[3] == "buy" and k is not None and x[1] == k and 0 <= (x[2] - t).total_seconds() <= 200]
            expected += [(i, x[0], x[2]) for x in hits] or [(i, None, None)]
    assert sorted(((r.id, r.buy_id, r.at) for r in got), key=repr) == sorted(expected, key=repr)
    assert any(x[1] is None for x in expected) and any(x[1] is not None for x in expected)


def test_closing_of_an_empty_table(spark):
    assert ev.closing(inline_rows(spark, [], SCHEMA), "ts", 10).count() == 0
    assert ev.closing(inline_rows(spark, [], SCHEMA), "ts", 10, by=["what"], keys=["k"]).count() == 0
