"""Running values, ranks, moving frames and sessions against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazeline.operators import scans
from hazeline.operators.sessions import numbered, sessions
from hazeline.sources.inline import inline_rows

SCHEMA = "id int, k string, t int, v int"


def table(rng, n, hot=0.4):
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None, ""])
        rows.append((i, k, rng.choice([None, *range(n // 4)]), rng.choice([None, *range(-5, 6)])))
    return rows


def in_order(rows, by):
    groups = {}
    for r in sorted(rows, key=by):
        groups.setdefault(r[1], []).append(r)
    return groups


def by_time(r):
    return (r[2] is not None, r[2] or 0, r[0])


@pytest.mark.parametrize("n,blocks", [(0, 3), (7, 5), (400, 1), (400, 64)])
def test_running(spark, n, blocks):
    rows = table(random.Random(n + blocks), n)
    wanted = {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v")),
              "at": ("last", F.col("v"))}
    df = inline_rows(spark, rows, SCHEMA)
    for before in (False, True):
        got = {r.id: (r.s, r.n, r.lo, r.hi, r.at) for r in scans.running(df, ["k"], ["t", "id"], wanted, before, blocks).collect()}
        assert len(got) == n
        for group in in_order(rows, by_time).values():
            for i, r in enumerate(group):
                seen = [x[3] for x in group[:i + (not before)] if x[3] is not None]
                assert got[r[0]] == ((sum(seen), len(seen), min(seen), max(seen), seen[-1]) if seen else (None, 0, None, None, None))


@pytest.mark.parametrize("blocks", [13, 80])
def test_ranks_with_ties_across_blocks(spark, blocks):
    rng = random.Random(blocks)
    rows = [(i, rng.choice(["x", "x", "x", None]), rng.choice([None, 1, 2, 2, 2, 3]), 0) for i in range(300)]
    out = scans.ranked(inline_rows(spark, rows, SCHEMA), ["k"], ["t desc"], blocks=blocks)
    got = {r.id: r for r in out.collect()}
    for group in in_order(rows, lambda r: (r[2] is None, -(r[2] or 0))).values():
        order = [r[2] for r in group]
        for r in group:
            first = order.index(r[2])
            assert got[r[0]].rank == first + 1
            assert got[r[0]].dense_rank == len(set(order[:first])) + 1
        assert sorted(got[r[0]].row_number for r in group) == list(range(1, len(group) + 1))
    hot = out.groupBy("k").count().orderBy(F.desc("count")).first()[1]
    spread = scans.deal(inline_rows(spark, rows, SCHEMA), ["k"], ["t"], blocks=blocks).groupBy("b").count()
    assert blocks == 1 or max(r[1] for r in spread.collect()) < hot


@pytest.mark.parametrize("before,after,chunk", [(0, 2, 2), (5, 5, 1), (2, 1, 1000), (40, 0, 7)])
def test_moving_frames_across_chunks(spark, before, after, chunk):
    rows = table(random.Random(before), 250)
    out = scans.moving(inline_rows(spark, rows, SCHEMA), ["k"], ["t", "id"], {"s": (F.sum, F.col("v")), "lo": (F.min, F.col("v")), "n": (F.count, F.lit(1))},
                       before, after, chunk_rows=chunk, blocks=11)
    got = {r.id: (r.s, r.lo, r.n) for r in out.collect()}
    assert len(got) == 250
    for group in in_order(rows, by_time).values():
        for i, r in enumerate(group):
            frame = group[max(0, i - before):i + after + 1]
            seen = [x[3] for x in frame if x[3] is not None]
            assert got[r[0]] == (sum(seen) if seen else None, min(seen, default=None), len(frame))


def test_names_do_not_clash(spark):
    rows = [(1, 2, 3, 4, 5, 6, 7), (2, 2, 3, 4, 5, 6, 8)]
    df = inline_rows(spark, rows, "b int, m int, k int, row int, o int, `v0` int, `x.y` int")
    out = scans.running(df, ["m"], ["b", "x.y"], {"row": ("sum", F.col("`x.y`"))})
    assert out.columns == ["b", "m", "k", "o", "v0", "x.y", "row"]
    assert sorted(r.row for r in out.collect()) == [7, 15]


T0 = dt.datetime(2024, 3, 9, 23)


def events(rng, n):
    at = {k: 0 for k in "abc"}
    rows = []
    for i in range(n):
        k = rng.choice("aaaab" + "c")
        at[k] += rng.choice([0, 1, 59, 60, 61, 600])
        rows.append((i, k if k != "c" else None, T0 + dt.timedelta(seconds=at[k]), i % 7))
    rng.shuffle(rows)
    return rows


def plain_sessions(rows, gap):
    out = []
    for k in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == k and r[2] is not None), key=lambda r: r[2])
        for i, r in enumerate(own):
            if i == 0 or (r[2] - own[i - 1][2]).total_seconds() > gap:
                out.append([k, r[2], None, 0, 0])
            out[-1][2:] = r[2] + dt.timedelta(seconds=gap), out[-1][3] + 1, out[-1][4] + r[3]
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_sessions(spark, kind):
    rows = events(random.Random(2), 300) + [(999, "a", None, 1)]
    df = inline_rows(spark, rows, f"id int, k string, session {kind}, v int")  # its own name as the time's
    out = sessions(df, ["k"], "session", 60, {"s": F.sum("v")}, blocks=17)
    assert sorted(map(tuple, out.collect()), key=repr) == plain_sessions(rows, 60)
    native = (df.where("session is not null").groupBy("k", F.session_window("session", "60 seconds").alias("w"))
              .agg(F.count("*").alias("n"), F.sum("v").alias("s")).select("k", "w.start", "w.end", "n", "s"))
    assert out.exceptAll(native).isEmpty() and native.exceptAll(out).isEmpty()
    assert sessions(df.limit(0), ["k"], "session", 60).count() == 0


def test_numbered_keeps_rows(spark):
    rows = events(random.Random(3), 50)
    out = numbered(inline_rows(spark, rows, "id int, k string, t timestamp, v int"), ["k"], "t", 60, blocks=4)
    assert out.count() == 50 and out.columns == ["id", "k", "t", "v", "session"]
