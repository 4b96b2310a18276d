"""Group statistics, lattices, bags, distinct counts and top k against plain
versions."""

import datetime as dt
import math
import random
import statistics
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from hazeline.operators import bags, distinct, groupstats, lattice, topk
from hazeline.sources.inline import inline_rows

SCHEMA = "id int, k string, x double, y double, t string"


def table(rng, n):
    hot = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    rows = [(i, hot(), rng.choice([None, float("nan"), *map(float, range(-4, 5))]), rng.choice([None, rng.random()]),
             rng.choice([None, "p", "q", "r"])) for i in range(n)]
    return rows + [(9000, "empty", None, float("nan"), None), (9001, "one", 3.0, 4.0, "p")]


def known(values):
    return [v for v in values if v is not None and v == v]


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return out


def quantile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return values[lo] + (values[hi] - values[lo]) * (at - lo)


@pytest.mark.parametrize("q,blocks", [(0.5, 1), (0.5, 40), (1.0, 7), (0.9, 7)])
def test_quantiles_of_many_groups(spark, q, blocks):
    rows = table(random.Random(blocks), 300)
    out = groupstats.quantiles(inline_rows(spark, rows, SCHEMA), ["k"], ["x", "y"], q, blocks=blocks)
    got = {r.k: (r.x, r.y) for r in out.collect()}
    assert set(got) == {r[1] for r in rows}
    for k, own in groups(rows).items():
        for c, value in zip((2, 3), got[k]):
            seen = known(r[c] for r in own)
            assert value == pytest.approx(quantile(seen, q)) if seen else value is None


def test_modes(spark):
    rows = table(random.Random(4), 300)
    df = inline_rows(spark, rows, SCHEMA)
    got = {r.k: r.x for r in groupstats.modes(df, ["k"], ["x"]).collect()}
    for k, own in groups(rows).items():
        seen = Counter(known(r[2] for r in own))
        assert got[k] == (min(seen, key=lambda v: (-seen[v], v)) if seen else None)
    with pytest.raises(ValueError):
        groupstats.modes(df, ["k"], ["x", "t"])


@pytest.mark.parametrize("how", ["mean", "median", "mode"])
def test_impute(spark, how):
    rows = table(random.Random(6), 200)
    df = inline_rows(spark, rows, SCHEMA)
    cols = ["x", "y", "t"] if how == "mode" else ["x", "y"]
    out = groupstats.impute(df, ["k"], cols, how)
    assert out.columns == df.columns
    got = {r.id: r for r in out.collect()}
    plain = {"mean": statistics.fmean, "median": statistics.median, "mode": lambda v: min(v, key=lambda x: (-v.count(x), x))}[how]
    for own in groups(rows).values():
        for c, name in ((2, "x"), (3, "y"), (4, "t")):
            seen = known(r[c] for r in own)
            for r in own:
                value = got[r[0]][name]
                if name not in cols or r[c] is not None and r[c] == r[c]:
                    assert value == r[c]
                elif seen:
                    assert value == (plain(seen) if name == "t" else pytest.approx(plain(seen)))
                else:
                    assert value is None
    assert groupstats.impute(df.limit(0), ["k"], cols, how).count() == 0
    with pytest.raises(ValueError):
        groupstats.impute(df, ["k"], cols, "least")


def test_cube_and_rollup(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([True, False]), rng.choice([None, 1e9 + rng.random()])) for _ in range(200)]
    rows += [("one", 7, True, 2.0)]
    df = inline_rows(spark, rows, "p string, q int, r boolean, x double")
    keys = ["p", "q", "r"]
    for fn, sets in ((lattice.cube, [s for n in range(4) for s in combinations(range(3), n)]), (lattice.rollup, [(), (0,), (0, 1), (0, 1, 2)])):
        expected = {}
        for s in sets:
            for row in rows:
                key = (*(row[i] if i in s else None for i in range(3)), sum(1 << (2 - i) for i in range(3) if i not in s))
                expected.setdefault(key, []).append(row[3])
        got = {(r.p, r.q, r.r, r.grouping_id): r for r in fn(df, keys, ["x"]).collect()}
        assert set(got) == set(expected)
        for key, values in expected.items():
            seen, r = known(values), got[key]
            assert (r.n_rows, r.x_n) == (len(values), len(seen))
            if seen:
                assert r.x_sum == pytest.approx(sum(seen)) and r.x_mean == pytest.approx(statistics.fmean(seen), rel=1e-12)
                assert (r.x_min, r.x_max) == (min(seen), max(seen))
                assert r.x_std == (pytest.approx(statistics.stdev(seen), rel=1e-6, abs=1e-6) if len(seen) > 1 else None)
            else:
                assert r.x_sum is None and r.x_mean is None
    total = lattice.cube(df.limit(0), keys, ["x"]).collect()
    assert [(r.n_rows, r.x_n, r.grouping_id) for r in total] == [(0, 0, 7)]
    with pytest.raises(ValueError):
        lattice.grouping_sets(df, ["p"], [("q",)], [])
    plan = lattice.cube(df, keys, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_bags(spark, monkeypatch):
    monkeypatch.setattr(bags, "STEP", 3)
    rng = random.Random(1)
    row = lambda: (rng.choice(["a", None]), rng.choice([1, 2, None]))
    left, right = [row() for _ in range(60)], [row() for _ in range(40)] + [("only", 5)] * 4
    a = inline_rows(spark, left, "n_left string, row int")
    b = inline_rows(spark, right, "n_left string, row int").select("row", "n_left")
    l, r = Counter(left), Counter(right)
    assert Counter(map(tuple, bags.intersect_all(a, b).collect())) == l & r
    assert Counter(map(tuple, bags.except_all(a, b).collect())) == l - r
    assert Counter(map(tuple, bags.except_all(b, a).select("n_left", "row").collect())) == r - l
    got = {x[0]: (x.n_old, x.n_new, x.n_same, x.change) for x in bags.changes(a, b, ["n_left"]).collect()}
    for k in {"a", None, "only"}:
        own, other = Counter(x for x in left if x[0] == k), Counter(x for x in right if x[0] == k)
        what = "added" if not own else "removed" if not other else "same" if own == other else "changed"
        assert got[k] == (own.total(), other.total(), (own & other).total(), what)
    assert [x.change for x in bags.changes(a, a, ["row"]).select("change").distinct().collect()] == ["same"]
    assert bags.intersect_all(a, b.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bags.except_all(a, b.drop("row"))


def test_distinct_counts_add_up(spark):
    d0 = dt.date(2024, 2, 27)
    rng = random.Random(2)
    rows = [(d0 + dt.timedelta(days=rng.randrange(6)), rng.choice([None, rng.randrange(-70_000, 70_000)])) for _ in range(3000)]
    df = inline_rows(spark, rows, "day date, v bigint")
    exact = distinct.trailing(distinct.bitmaps(df, ["day"], "v"), "day", 3)
    rough = distinct.trailing(distinct.sketches(df, ["day"], "v"), "day", 3)
    got = {r.until: r.n_distinct for r in distinct.exact_counts(exact, ["until"]).collect()}
    near = {r.until: r.estimate for r in distinct.estimates(rough, ["until"]).collect()}
    for until, n in got.items():
        true = len({v for d, v in rows if v is not None and until - dt.timedelta(days=2) <= d <= until})
        assert n == true and abs(near[until] - true) <= 4 * distinct.standard_error() * true
    assert len(got) == 8
    some = distinct.day_range(distinct.bitmaps(df, ["day"], "v"), "day", F.lit(d0), F.lit(d0 + dt.timedelta(days=1)))
    assert distinct.exact_counts(some, []).first()[0] == len({v for d, v in rows if v is not None and (d - d0).days <= 1})


def test_error_of_sketches_is_as_told(spark):
    df = spark.range(400_000).select((F.col("id") % 100).alias("day"), F.xxhash64("id").alias("v"))
    found = distinct.estimates(distinct.sketches(df, ["day"], "v", 10), []).first()[0]
    assert abs(found - 400_000) <= 4 * distinct.standard_error(10) * 400_000


@pytest.mark.parametrize("with_ties", [False, True])
def test_top_k(spark, with_ties):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(12)])) for i in range(200)]
    df = inline_rows(spark, rows, "place int, k string, part int")
    order = ["part desc"] if with_ties else ["part desc", "place"]
    got = sorted(map(tuple, topk.top_k(df, ["k"], order, 5, with_ties).collect()), key=repr)
    expected = []
    for own in groups(rows).values():
        own = sorted(own, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        edge = own[min(4, len(own) - 1)][2]
        expected += [r for i, r in enumerate(own) if i < 5 or with_ties and r[2] == edge]
    assert got == sorted(expected, key=repr)
    assert topk.top_k(df, [], ["place"], 3).count() == 3 and topk.top_k(df.limit(0), ["k"], ["place"], 3).count() == 0
