"""Distinct counts that add up: daily state that is stored, merged for any range
of days and counted.

Two states of the same rows. A sketch (HyperLogLog) takes any value and has a
bounded size and an expected error; bitmaps take whole numbers, are exact, and are
kept in buckets of 32,768 values, so neither a value range nor a hot day is one
row. Both merge by a partial aggregate, so a range costs its state, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's registers; the standard error is about
#: 1.04 / sqrt(2^k).
LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def sketches(df: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """State to store: the keys (a day among them) and ``sketch``. Nulls aren't
    counted."""
    known = df.where(F.col(f"`{value}`").isNotNull())
    return known.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.hll_sketch_agg(F.col(f"`{value}`"), lg_k).alias("sketch"))


def estimates(state: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated distinct values of each key over the state's other keys."""
    return state.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def bitmaps(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """State to store for a column of whole numbers: the keys, ``bucket`` and
    ``bitmap``. Nulls aren't counted."""
    v = F.col(f"`{value}`").cast("long")
    known = df.where(v.isNotNull())
    return known.groupBy(*(F.col(f"`{k}`") for k in keys), F.bitmap_bucket_number(v).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap"))


def exact_counts(state: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of each key over the state's other keys, exactly."""
    by = [F.col(f"`{k}`") for k in keys]
    merged = state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("n_distinct"))


def day_range(state: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """State of the days from first to last."""
    return state.where(F.col(f"`{day}`").between(first, last))


def trailing(state: DataFrame, day: str, days: int, name: str = "until") -> DataFrame:
    """State for ranges of so many days up to each day that occurs or follows
    within the range: each row once for every range that holds its day."""
    d = F.col(f"`{day}`")
    return state.withColumn(name, F.explode(F.sequence(d, F.date_add(d, days - 1))))
