"""Joins: boundary join, daily-series join, row-aligned join, as-of join and
interval join.

Broadcast is never assumed: ``sized_broadcast`` hints a side only when the
optimizer's size estimate is under the session's broadcast threshold, and
otherwise leaves the shuffle (sort-merge) join, which AQE may still turn
into a broadcast from runtime sizes or split when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.dates import ticks
from hazeline.operators.scans import running

DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a DataFrame (no job is run)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())
    except Exception:  # noqa: BLE001 - not available (e.g. Spark Connect)
        return None


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; 0 when the session
    disables automatic broadcasts (then no size-checked hint is added)."""
    v = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    if v is None:
        return DEFAULT_BROADCAST_BYTES
    t = str(v).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    try:
        t = t[:-1] if t.endswith("b") else t
        n = int(float(t[:-1]) * units[t[-1]]) if t and t[-1] in units else int(t)
    except ValueError:
        return DEFAULT_BROADCAST_BYTES
    return max(n, 0)


def sized_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its estimated size is known and under the limit;
    the unchanged frame (shuffle join) otherwise."""
    limit = max_bytes if max_bytes is not None else broadcast_limit(df)
    size = estimated_bytes(df)
    return F.broadcast(df) if limit > 0 and size is not None and size <= limit else df


def boundary_join(boundaries: DataFrame, name_col: str, values: DataFrame, key_col: str) -> DataFrame:
    """Inner equi-join of boundaries (left) with per-district values on
    different key names; the right key is dropped. Districts without a
    boundary or without values vanish; several rows per district stay."""
    b = sized_broadcast(boundaries)
    return b.join(values, b[name_col] == values[key_col], "inner").drop(values[key_col])


def series_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Inner equi-join of two keyed series, both keys kept."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def with_ordinal(df: DataFrame, order_col: str, name: str = "ordinal",
                 buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_col`` order (null first), without
    a global single-partition window.

    Rows are dealt to range partitions by the column and a random second key,
    so a value that holds a third of all rows spreads over several partitions
    (ties have no order), and sorted there. A row's place in its partition
    comes from ``monotonically_increasing_id``. The result is checkpointed, as
    both passes must see the same deal; then each partition is shifted by the
    rows of all earlier ones (a table of one row per partition)."""
    from hazeline.session import scratch_dir
    scratch_dir(df.sparkSession)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.withColumn("_s", F.rand(17)).repartitionByRange(n, order_col, "_s")
             .sortWithinPartitions(order_col, "_s").withColumn("_m", F.monotonically_increasing_id())
             .withColumns({"_b": F.shiftright("_m", 33), "_local": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))})
             .drop("_s", "_m").checkpoint())
    counts = dealt.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets holds one row per partition: a proven bound, so it is broadcast.
    return (dealt.join(F.broadcast(offsets), "_b").withColumn(name, F.col("_off") + F.col("_local"))
                 .drop("_b", "_local", "_off"))


def row_aligned_join(left: DataFrame, left_order: str, right: DataFrame,
                     right_order: str) -> DataFrame:
    """Horizontal concatenation of two frames, inner on row position."""
    lo = with_ordinal(left, left_order)
    ro = with_ordinal(right, right_order)
    return lo.join(ro, "ordinal", "inner")


def _kind(df: DataFrame, c: str) -> str:
    return df.schema[c].dataType.simpleString()


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, columns: list[str],
              on: list[str] = (), ties: list[str] = (), strict: bool = False, within: int | None = None,
              how: str = "left", blocks: int | None = None) -> DataFrame:
    """Every left row with ``columns`` of the right row of its keys that has the
    greatest time at or before its own (before it, with ``strict``).

    Of right rows of one time the one with the greatest ``ties`` columns is taken.
    ``within`` bounds how far back it may lie (microseconds for timestamps, days
    for dates, units for integers); beyond it there is no match. Without a match
    the columns are null, or the row is left out with ``how="inner"``. Null keys
    and null times match nothing. The columns must not be named like left ones.

    Both sides go as one table through a scan of the last right row so far
    (``operators.scans``): no key is one window, and left rows are not joined to
    candidates, whose number could be a square."""
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = F.col(f"`{right_time}`").isNotNull()
    for c in on:
        known = known & F.col(f"`{c}`").isNotNull()
    keys = [f"k{i}" for i in range(len(on))]
    tie_names = [f"t{i}" for i in range(len(ties))]
    tie_types = [right.schema[c].dataType for c in ties]
    payload = F.struct(F.col(f"`{right_time}`").alias("at"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("columns"))
    own = left.select(F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("own"),
                      *(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), F.col(f"`{left_time}`").alias("at"),
                      F.lit(0 if strict else 1).alias("side"), *(F.lit(None).cast(t).alias(n) for t, n in zip(tie_types, tie_names)))
    other = right.where(known).select(*(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), F.col(f"`{right_time}`").alias("at"),
                                      F.lit(1 if strict else 0).alias("side"), *(F.col(f"`{c}`").alias(n) for c, n in zip(ties, tie_names)),
                                      payload.alias("hit"))
    both = own.unionByName(other, allowMissingColumns=True)
    both = running(both, keys, ["at", "side", *tie_names], {"hit": ("last", F.col("hit"))}, blocks=blocks).where("own is not null")
    matched = F.col("hit").isNotNull()
    if within is not None:
        age = ticks("at", _kind(both, "at")) - ticks("hit.at", _kind(right, right_time))
        matched = matched & (age <= within)
    out = both if how == "left" else both.where(matched)
    return out.select("own.*", *(F.when(matched, F.col(f"hit.columns.`{c}`")).alias(c) for c in columns))


#: Interval lengths of a level are within this factor.
_LEVEL = 4


def _level(length: Column) -> Column:
    """The least level whose buckets are as wide as an interval is long."""
    return F.ceil(F.log(float(_LEVEL), length)).cast("int")


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
                  columns: list[str], on: list[str] = ()) -> DataFrame:
    """Every point with ``columns`` of each interval of its keys that holds it
    (start <= point < end), once per pair; points in no interval are left out.

    Intervals are put to levels by their length, in steps of four, and cut into
    buckets as wide as the longest of their level: one takes two buckets at most
    (three by rounding), and a point lies in one bucket of each level that occurs.
    So pairs meet in an equality join on key, level and bucket, each in one
    bucket, and a bucket's candidates are a small multiple of its true pairs
    where points are spread evenly. A hot key lies in many buckets; a hot bucket
    is for Spark's skew join. Null or reversed bounds, null points and null keys
    match nothing. The bounds are timestamps, dates or integers like the point."""
    if clash := set(columns) & set(points.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = [f"k{i}" for i in range(len(on))]
    lo, hi, at = (ticks(f"`{c}`", _kind(df, c)) for df, c in ((intervals, start), (intervals, end), (points, point)))
    held = intervals.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), lo.alias("lo"), hi.alias("hi"),
                            F.struct(*(F.col(f"`{c}`") for c in columns)).alias("of")).where("lo < hi")
    held = held.withColumn("level", _level(F.col("hi") - F.col("lo")))
    # A number for each power of four: what reaches the driver is bounded by the type.
    levels = sorted(r["level"] for r in held.select("level").distinct().collect())
    bucket = lambda c, level: F.floor(c / F.pow(F.lit(float(_LEVEL)), level))
    held = held.withColumn("bucket", F.explode(F.sequence(bucket(F.col("lo"), F.col("level")), bucket(F.col("hi") - 1, F.col("level")))))
    own = points.select(F.struct(*(F.col(f"`{c}`") for c in points.columns)).alias("own"),
                        *(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), at.alias("at")).where("at is not null")
    own = own.withColumn("level", F.explode(F.array(*(F.lit(x) for x in levels)).cast("array<int>")))
    own = own.withColumn("bucket", bucket(F.col("at"), F.col("level")))
    found = own.join(held, [*keys, "level", "bucket"]).where("lo <= at and at < hi")
    return found.select("own.*", *(F.col(f"of.`{c}`").alias(c) for c in columns))


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str],
                 columns: list[str], on: list[str] = ()) -> DataFrame:
    """Every left interval with ``columns`` of each right interval of its keys
    that overlaps it, once per pair. Of two such intervals either the left one
    starts within the right one, or the right one starts within the left one and
    later: two interval joins, which have no pair in common. Empty, reversed and
    null intervals overlap nothing."""
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    pick = lambda df, cols, as_: F.struct(*(F.col(f"`{c}`") for c in cols)).alias(as_)
    keys = [f"k{i}" for i in range(len(on))]
    side = lambda df, bounds, cols, name: df.select(
        *(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)), pick(df, cols, name),
        *(ticks(f"`{c}`", _kind(df, c)).alias(f"{name}_{b}") for c, b in zip(bounds, ("lo", "hi")))).where(f"{name}_lo < {name}_hi")
    a, b = side(left, left_bounds, left.columns, "own"), side(right, right_bounds, columns, "other")
    starts_in = interval_join(a.drop("own_hi"), b, "own_lo", "other_lo", "other_hi", ["other"], on=keys)
    later = a.withColumn("from", F.col("own_lo") + 1)
    held = interval_join(b.drop("other_hi"), later, "other_lo", "from", "own_hi", ["own"], on=keys)
    return starts_in.select("own", "other").union(held.select("own", "other")).select("own.*", "other.*")
