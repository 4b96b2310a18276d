"""Joins: boundary join semantics and the distributed ordinal."""

import random

from pyspark.sql import functions as F

from hazeline.operators import joins
from hazeline.sources.inline import inline_rows


def test_boundary_join_drops_unmatched(spark):
    geo = inline_rows(spark, [("A", "g1"), ("B", "g2"), ("Z", "g9")], "SIG_ENG_NM string, geometry string")
    vals = inline_rows(spark, [("A", 1, 1.0), ("A", 2, 2.0), ("C", 3, 3.0)],
                       "district string, station int, v double")
    out = joins.boundary_join(geo, "SIG_ENG_NM", vals, "district")
    assert "district" not in out.columns
    assert sorted((r.SIG_ENG_NM, r.station) for r in out.collect()) == [("A", 1), ("A", 2)]


def test_sized_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert joins.estimated_bytes(small) is not None
    hinted = joins.sized_broadcast(small, max_bytes=10**9)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    not_hinted = joins.sized_broadcast(small, max_bytes=1)
    assert "broadcast" not in not_hinted._jdf.queryExecution().analyzed().toString().lower()


def test_ordinal_matches_sorted_position(spark):
    random.seed(7)
    vals = random.sample(range(100000), 3000)
    df = inline_rows(spark, [(v,) for v in vals], "v int")
    out = joins.with_ordinal(df, "v", buckets=13).collect()
    got = {r.v: r.ordinal for r in out}
    assert len(out) == 3000
    assert got == {v: i for i, v in enumerate(sorted(vals))}


def test_row_aligned_join_inner_on_position(spark):
    a = spark.range(0, 50).select((F.col("id") * 2).alias("x"))
    b = spark.range(0, 30).select((F.col("id") * 3).alias("y"))
    out = joins.row_aligned_join(a, "x", b, "y").collect()
    assert len(out) == 30
    assert all(r.x == 2 * r.ordinal and r.y == 3 * r.ordinal for r in out)


def test_ordinal_hot_value_is_split(spark):
    # One value holds a third of the rows: positions stay a permutation in
    # value order, and the hot value is spread over several buckets.
    hot = [(5000,)] * 4000
    rest = [(v,) for v in range(8000)]
    df = inline_rows(spark, hot + rest, "v int")
    out = joins.with_ordinal(df, "v", buckets=12)
    rows = out.collect()
    assert sorted(r.ordinal for r in rows) == list(range(12000))
    by_pos = [r.v for r in sorted(rows, key=lambda r: r.ordinal)]
    assert by_pos == sorted(v for (v,) in hot + rest)


def test_cluster_settings_scale():
    from hazeline.session import cluster_settings
    c = cluster_settings(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_settings(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_ordinal_with_nulls_and_many_buckets(spark):
    df = inline_rows(spark, [(v if v % 5 else None,) for v in range(400)], "v int")
    rows = sorted(joins.with_ordinal(df, "v", buckets=64).collect(), key=lambda r: r.ordinal)
    assert [r.ordinal for r in rows] == list(range(400))
    assert [r.v for r in rows] == [None] * 80 + [v for v in range(400) if v % 5]
