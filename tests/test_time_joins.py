"""As-of, interval and overlap joins against all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazeline.functions.dates import ticks
from hazeline.operators import joins
from hazeline.sources.inline import inline_rows

T0 = dt.datetime(2024, 3, 10, 1)


def when(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


@pytest.mark.parametrize("strict,within,blocks", [(False, None, 1), (True, None, 23), (False, 40, 7), (True, 3, 64)])
def test_asof(spark, strict, within, blocks):
    rng = random.Random(blocks)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    left = [(i, key(), rng.choice([None, *range(200)])) for i in range(300)]
    right = [(key(), rng.choice([None, *range(0, 200, 3)]), i, rng.choice([None, i])) for i in range(150)]
    r = inline_rows(spark, [(k, when(t), i, v) for k, t, i, v in right], "k string, at timestamp, n int, v int")
    l = inline_rows(spark, [(i, k, when(t)) for i, k, t in left], "id int, k string, own timestamp")
    out = joins.asof_join(l, r, "own", "at", ["at", "n", "v"], on=["k"], ties=["n"], strict=strict,
                          within=None if within is None else within * 1_000_000, blocks=blocks)
    got = {x.id: (x.at, x.n, x.v) for x in out.collect()}
    assert len(got) == 300 and out.columns == ["id", "k", "own", "at", "n", "v"]
    hits = 0
    for i, k, t in left:
        fits = [(a, n, v) for kk, a, n, v in right if None not in (k, kk, a, t) and k == kk and (a < t if strict else a <= t)]
        best = max(fits, key=lambda x: x[:2], default=None)
        if best and within is not None and t - best[0] > within:
            best = None
        hits += best is not None
        assert got[i] == ((when(best[0]), *best[1:]) if best else (None, None, None))
    inner = joins.asof_join(l, r, "own", "at", ["n"], on=["k"], ties=["n"], strict=strict, how="inner",
                            within=None if within is None else within * 1_000_000)
    assert inner.count() == hits


def test_asof_without_keys_and_with_empty_sides(spark):
    l = inline_rows(spark, [(i, i) for i in range(10)], "id int, t int")
    r = inline_rows(spark, [(3, "x"), (7, "y")], "t int, what string")
    got = {x.id: x.what for x in joins.asof_join(l, r, "t", "t", ["what"]).collect()}
    assert got == {i: None if i < 3 else "x" if i < 7 else "y" for i in range(10)}
    assert joins.asof_join(l, r.limit(0), "t", "t", ["what"]).where("what is null").count() == 10
    assert joins.asof_join(l.limit(0), r, "t", "t", ["what"]).count() == 0
    with pytest.raises(ValueError):
        joins.asof_join(l, r, "t", "t", ["t"])


def spans(rng, n, far):
    rows = []
    for i in range(n):
        lo = rng.randrange(-far, far)
        length = rng.choice([0, 1, 1, 2, 3, 4, 5, 16, 17, 63, 64, far, -4, None])
        rows.append((rng.choice(["hot", "hot", "a", None]), rng.choice([lo, lo, None]), None if length is None else lo + length, i))
    return rows


@pytest.mark.parametrize("far", [30, 100_000])
def test_interval_join_finds_every_pair_once(spark, far):
    rng = random.Random(far)
    held = spans(rng, 200, far)
    points = [(i, rng.choice(["hot", "a", None]), rng.choice([None, rng.randrange(-far, far)])) for i in range(300)]
    points += [(1000 + i, k, lo) for i, (k, lo, _, _) in enumerate(held)] + [(2000 + i, k, hi) for i, (k, _, hi, _) in enumerate(held)]
    p = inline_rows(spark, points, "id int, k string, at bigint")
    h = inline_rows(spark, held, "k string, lo bigint, hi bigint, n int")
    expected = sorted((i, n) for i, k, t in points for kk, lo, hi, n in held
                      if None not in (k, t, lo, hi) and k == kk and lo <= t < hi)
    out = joins.interval_join(p, h, "at", "lo", "hi", ["n"], on=["k"])
    assert sorted((r.id, r.n) for r in out.collect()) == expected and out.columns == ["id", "k", "at", "n"]
    alone = joins.interval_join(p, h, "at", "lo", "hi", ["n"])
    assert alone.count() == sum(1 for _, _, t in points for _, lo, hi, _ in held if None not in (t, lo, hi) and lo <= t < hi)
    assert joins.interval_join(p, h.limit(0), "at", "lo", "hi", ["n"], on=["k"]).count() == 0


def test_overlaps(spark):
    rng = random.Random(8)
    a, b = spans(rng, 120, 60), spans(rng, 120, 60)
    out = joins.overlap_join(inline_rows(spark, a, "k string, lo int, hi int, n int"), inline_rows(spark, b, "k string, s int, e int, m int"),
                             ("lo", "hi"), ("s", "e"), ["m"], on=["k"])
    fine = lambda r: None not in r and r[1] < r[2]
    expected = sorted((x[3], y[3]) for x in a for y in b if fine(x) and fine(y) and x[0] == y[0] and max(x[1], y[1]) < min(x[2], y[2]))
    assert sorted((r.n, r.m) for r in out.collect()) == expected and expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_interval_join_of_times(spark, kind):
    day = 86_400
    p = inline_rows(spark, [(i, when(i * day)) for i in range(-3, 12)], "id int, t timestamp").withColumn("t", F.col("t").cast(kind))
    h = inline_rows(spark, [(when(0), when(5 * day), "x"), (when(4 * day), when(40 * day), "y")], "lo timestamp, hi timestamp, n string")
    h = h.withColumns({"lo": F.col("lo").cast(kind), "hi": F.col("hi").cast(kind)})
    got = sorted((r.id, r.n) for r in joins.interval_join(p, h, "t", "lo", "hi", ["n"]).collect())
    assert got == sorted([(i, "x") for i in range(5)] + [(i, "y") for i in range(4, 12)])


def test_ticks_of_a_clock_without_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks change on 10 March
    try:
        df = spark.sql("select id, timestamp_ntz'2024-03-10 01:59:59.000001' + make_dt_interval(0, 0, 0, id) as t from range(4000)")
        got = [r[0] for r in df.orderBy("id").select(ticks("t", "timestamp_ntz")).collect()]
        assert got == [1710035999000001 + 86_400 * 0 + i * 1_000_000 for i in range(4000)]
        early = spark.sql("select timestamp_ntz'1969-12-31 23:59:58.5' as t").select(ticks("t", "timestamp_ntz")).first()[0]
        assert early == -1_500_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError):
        ticks("x", "double")


def test_no_nested_loops(spark):
    from __spark_entry__ import queries
    for name in ("asof_last_view", "asof_order_before", "interval_events", "overlap_open_orders"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan, plan
