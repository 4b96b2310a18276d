"""Set operations on tables as bags: how often each row occurs counts.

Both tables go through one aggregate, which counts each different row of either
side (partial in every task, so a row that fills a third of a table is one row per
task). All operations follow from these two counts. Rows are compared column by
column, nulls equal to nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of a row that one step of an expansion makes at most.
STEP = 1 << 12


def multiplicities(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each different row of either table once: ``row`` (a struct), ``n_left`` and
    ``n_right``. The right table has the columns of the left one, in any order."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the tables have different columns")
    row = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    both = left.select(row.alias("row"), F.lit(1).alias("l"), F.lit(0).alias("r")).union(
        right.select(row.alias("row"), F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy("row").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def _repeated(counted: DataFrame, n: Column) -> DataFrame:
    """Each row n times, in two steps, so that no list is longer than a step or
    than n / STEP."""
    steps = counted.withColumn("n", n).where("n > 0").select("row", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(STEP))).alias("at"))
    return steps.select("row", F.explode(F.sequence(F.lit(1), F.least(F.col("n") - F.col("at"), F.lit(STEP))))).select("row.*")


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables, as often as in the one that has fewer of them."""
    return _repeated(multiplicities(left, right), F.least("n_left", "n_right"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left table, as often as it has more of them."""
    return _repeated(multiplicities(left, right), F.col("n_left") - F.col("n_right"))


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What became of each key: the keys, n_old and n_new rows, n_same (rows of
    both, each as often as in the one that has fewer), and change: ``added`` (no
    old row), ``removed`` (no new one), ``same`` (all rows are), else ``changed``.
    Null keys are a key."""
    counted = multiplicities(old, new)
    by_key = counted.groupBy(*(F.col(f"row.`{k}`").alias(k) for k in keys)).agg(
        F.sum("n_left").alias("n_old"), F.sum("n_right").alias("n_new"), F.sum(F.least("n_left", "n_right")).alias("n_same"))
    same = (F.col("n_same") == F.col("n_old")) & (F.col("n_same") == F.col("n_new"))
    return by_key.withColumn("change", F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed")
                             .when(same, "same").otherwise("changed"))
