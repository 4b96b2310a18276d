"""Exact quantiles and modes of many groups at once, and imputation by them.

Values are counted by group first (partial in every task, so repeated values cost
one row), then the counts of each group are summed up in value order by a scan
over blocks (``operators.scans``): the value at a rank is the first whose running
count reaches it. A group that holds a third of all rows is never in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.operators.scans import running
from hazeline.session import written


def _counts(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """How often each value occurs: k (keys as a struct), c (place in cols), v, n.
    Nulls and NaN aren't values. The columns have one type."""
    kinds = {df.schema[c].dataType.simpleString() for c in cols}
    if len(kinds) > 1:
        raise ValueError(f"columns of several types: {sorted(kinds)}")
    k = F.struct(*(F.col(f"`{c}`") for c in keys)) if keys else F.struct(F.lit(0).alias("all"))
    cells = F.array(*(F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(cols)))
    melted = df.select(k.alias("k"), F.inline(cells)).where("v is not null")
    if kinds <= {"double", "float"}:
        melted = melted.where(~F.isnan("v"))
    return melted.groupBy("k", "c", "v").agg(F.count("*").alias("n"))


def _wide(stats: DataFrame, keys: list[str], cols: list[str], value: str) -> DataFrame:
    """One row per group: the keys and the value of each column."""
    wide = stats.groupBy("k").agg(*(F.max(F.when(F.col("c") == i, F.col(value))).alias(f"s{i}") for i in range(len(cols))))
    return wide.select(*(F.col(f"k.`{k}`").alias(k) for k in keys), *(F.col(f"s{i}").alias(c) for i, c in enumerate(cols)))


def quantiles(df: DataFrame, keys: list[str], cols: list[str], q: float = 0.5, blocks: int | None = None) -> DataFrame:
    """The exact quantile of each numeric column by group, between the two
    values next to it in proportion (as SQL ``quantile_cont``): the keys and the
    columns. Groups without a value have null; null keys are a group."""
    counts = _counts(df, keys, cols).withColumn("v", F.col("v").cast("double"))
    total = written(counts.groupBy("k", "c").agg(F.sum("n").alias("total")), "totals")
    so_far = running(counts, ["k", "c"], ["v"], {"so_far": ("sum", F.col("n"))}, blocks=blocks)
    place = F.lit(q) * (F.col("total") - 1)
    ranked = so_far.join(total, ["k", "c"]).withColumn("place", place).withColumn("lower", F.floor("place"))
    at = lambda rank: F.min(F.when(F.col("so_far") > rank, F.col("v")))  # noqa: E731 - ranks from 0
    found = ranked.groupBy("k", "c").agg(at(F.col("lower")).alias("a"), at(F.ceil("place")).alias("b"),
                                         F.max(F.col("place") - F.col("lower")).alias("part"))
    found = found.withColumn("q", F.when(F.col("part") == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("part")))
    return _with_empty(df, _wide(found, keys, cols, "q"), keys, cols)


def modes(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The most frequent value of each column by group, the least of equally
    frequent ones: the keys and the columns (of one type). Groups without a value
    have null; null keys are a group."""
    best = F.min_by("v", F.struct(-F.col("n"), F.col("v")))
    found = _counts(df, keys, cols).groupBy("k", "c").agg(best.alias("mode"))
    return _with_empty(df, _wide(found, keys, cols, "mode"), keys, cols)


def means(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The mean of each column by group; NaN isn't a value."""
    return df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(
        *(F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))).alias(c) for c in cols))


def _same(keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys), F.lit(True))


def _with_empty(df: DataFrame, stats: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """A row also for groups that have no value at all."""
    if not keys:
        return stats
    groups = df.select(*(F.col(f"`{k}`") for k in keys)).distinct()
    return groups.alias("a").join(stats.alias("b"), _same(keys), "left").select("a.*", *(F.col(f"b.`{c}`") for c in cols))


def impute(df: DataFrame, keys: list[str], cols: list[str], how: str = "mean") -> DataFrame:
    """Nulls and NaN of the columns replaced by the mean, median or mode of their
    group; a group without any value keeps nulls. Mean and median give doubles.
    The other columns, and all rows, stay.

    The table of the groups is written first, so Spark knows its size and
    broadcasts it only if it is small; else a hot group is for its skew join."""
    if how == "mean":
        found = means(df, keys, cols)
    elif how == "median":
        found = quantiles(df, keys, cols, 0.5)
    elif how == "mode":
        by_kind: dict[str, list[str]] = {}
        for c in cols:
            by_kind.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
        tables = [modes(df, keys, cs).alias("a") for cs in by_kind.values()]
        found = tables[0]
        for t in tables[1:]:
            found = found.alias("a").join(t.alias("b"), _same(keys)).select("a.*", *(F.col(f"b.`{c}`") for c in t.columns if c not in keys))
    else:
        raise ValueError(f"how is {how!r}, not mean, median or mode")
    found = written(found, "imputed")
    numbers = {c for c in cols if df.schema[c].dataType.simpleString() in ("double", "float")}

    def filled(c: str) -> Column:
        own = F.col(f"a.`{c}`")
        known = F.when(~F.isnan(own), own) if c in numbers else own
        return F.coalesce(known, F.col(f"b.`{c}`")).alias(c)

    joined = df.alias("a").join(found.alias("b"), _same(keys), "left")
    return joined.select(*(filled(c) if c in cols else F.col(f"a.`{c}`") for c in df.columns))
