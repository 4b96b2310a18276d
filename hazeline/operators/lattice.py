"""Rollup, cube and grouping sets from one pass over the rows.

Rows are reduced to mergeable partials (counts, sums, squared deviations, least
and greatest) of the finest grouping, which are written; every coarser grouping is
made from those. Squared deviations of parts merge by the distance of their means
from the mean of the whole, so large values don't cancel. No row is copied for
each grouping, as an expansion of the raw rows does.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.session import written


def _partials(c: str, i: int) -> list[Column]:
    x = F.col(f"`{c}`").cast("double")
    return [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), (F.var_pop(x) * F.count(x)).alias(f"q{i}"),
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]


def _mean(i: int, prefix: str = "") -> Column:
    return F.try_divide(F.col(f"{prefix}s{i}"), F.col(f"{prefix}n{i}"))


def _merged(finest: DataFrame, by: list[str], n: int) -> DataFrame:
    """The partials of a coarser grouping."""
    sums = finest.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *(a for i in range(n) for a in (
        F.sum(f"n{i}").alias(f"n{i}"), F.sum(f"s{i}").alias(f"s{i}"), F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))))
    if not n:
        return sums
    if not by:  # one row: its means may go as literals
        whole = sums.first()
        about = [F.lit(whole[f"s{i}"] / whole[f"n{i}"] if whole[f"n{i}"] else None).cast("double") for i in range(n)]
        spread = finest.agg(*(F.sum(F.col(f"q{i}") + F.col(f"n{i}") * F.pow(_mean(i) - about[i], F.lit(2))).alias(f"q{i}") for i in range(n)))
        told = spread.first()
        return sums.withColumns({f"q{i}": F.lit(told[f"q{i}"]).cast("double") for i in range(n)})
    same = lambda other: reduce(Column.__and__, (F.col(f"f.{k}").eqNullSafe(F.col(f"{other}.{k}")) for k in by))
    joined = finest.alias("f").join(sums.alias("g"), same("g"))
    spread = joined.groupBy(*(F.col(f"f.{k}").alias(k) for k in by)).agg(*(
        F.sum(F.col(f"f.q{i}") + F.col(f"f.n{i}") * F.pow(_mean(i, "f.") - _mean(i, "g."), F.lit(2))).alias(f"q{i}") for i in range(n)))
    return sums.alias("f").join(spread.alias("q"), same("q")).select("f.*", *(F.col(f"q.q{i}") for i in range(n)))


def _told(c: str, i: int) -> list[Column]:
    n = F.col(f"n{i}")
    spread = F.when(n > 1, F.sqrt(F.try_divide(F.col(f"q{i}"), n - 1)))
    return [F.coalesce(n, F.lit(0)).alias(f"{c}_n"), F.col(f"s{i}").alias(f"{c}_sum"), _mean(i).alias(f"{c}_mean"), spread.alias(f"{c}_std"),
            F.col(f"lo{i}").alias(f"{c}_min"), F.col(f"hi{i}").alias(f"{c}_max")]


def grouping_sets(df: DataFrame, keys: list[str], sets: list[tuple[str, ...]], measures: list[str]) -> DataFrame:
    """One row per group of each set of keys: the keys (null where they are summed
    over), grouping_id (as SQL ``GROUPING``: a bit for each key that is summed
    over, the first key's highest), n_rows, and for each measure its count, sum,
    mean, sample standard deviation, least and greatest value. Null keys are
    groups of their own, told apart by grouping_id. The empty set gives one row,
    also for an empty table; a set given twice is one."""
    if unknown := {k for s in sets for k in s} - set(keys):
        raise ValueError(f"not among the keys: {sorted(unknown)}")
    finest = df.groupBy(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)))
    finest = written(finest.agg(F.count("*").alias("rows"), *(p for i, m in enumerate(measures) for p in _partials(m, i))), "finest")
    out = None
    for chosen in sorted({tuple(k for k in keys if k in s) for s in sets}):
        by = [f"k{i}" for i, k in enumerate(keys) if k in chosen]
        group = finest if len(by) == len(keys) and by else _merged(finest, by, len(measures))
        group = group.select(*(F.col(f"k{i}") if k in chosen else F.lit(None).cast(finest.schema[f"k{i}"].dataType).alias(f"k{i}") for i, k in enumerate(keys)),
                             F.lit(sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in chosen)).cast("long").alias("id"),
                             "rows", *(f"{p}{i}" for i in range(len(measures)) for p in ("n", "s", "q", "lo", "hi")))
        out = group if out is None else out.unionByName(group)
    return out.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), F.col("id").alias("grouping_id"), F.col("rows").alias("n_rows"),
                      *(t for i, m in enumerate(measures) for t in _told(m, i)))


def rollup(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """All leading keys, down to none."""
    return grouping_sets(df, keys, [tuple(keys[:n]) for n in range(len(keys) + 1)], measures)


def cube(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """All subsets of the keys."""
    return grouping_sets(df, keys, [s for n in range(len(keys) + 1) for s in combinations(keys, n)], measures)
