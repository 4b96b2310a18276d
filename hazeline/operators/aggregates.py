"""Grouped and global aggregates: means, profiles, ranges, histograms.

Every aggregate here is algebraic or has a mergeable sketch, so Spark runs
it as partial aggregation in each task followed by a shuffle of one partial
row per (task, group): a hot key costs one row per task, not its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.quantiles import exact_quantiles

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in ex]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def mean_by(df: DataFrame, keys: list[str], measures: list[str],
            prefix: str = "", drop_null_keys: bool = True) -> DataFrame:
    """Mean per group of every measure; output name ``prefix + measure``.
    NULL keys are dropped (the group-by semantics of the reference)."""
    if drop_null_keys and keys:
        for k in keys:
            df = df.filter(_q(k).isNotNull())
    aggs = [F.avg(_q(m)).alias(f"{prefix}{m}") for m in measures]
    return df.groupBy(*[_q(k) for k in keys]).agg(*aggs) if keys else df.agg(*aggs)


def mean_all_numeric(df: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """Mean of every numeric non-key column per group (text columns are left
    out, as the reference's ``.mean()`` does)."""
    return mean_by(df, keys, numeric_columns(df, keys), prefix)


def max_all_numeric(df: DataFrame, keys: list[str]) -> DataFrame:
    """``max(c)`` of every numeric non-key column per group, named like
    ``groupBy().max()`` does: ``max(<c>)``."""
    cols = numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.max(c).alias(f"max({c})") for c in cols])


def nonnull_count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-NULL count of every other column per group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.count(_q(c)).alias(c) for c in rest])


def measure_range(df: DataFrame, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Min and max per measure, globally or per group (a shared colour scale).
    ``+ 0.0`` turns a -0.0 minimum into 0.0."""
    aggs = []
    for m in measures:
        aggs += [(F.min(m) + F.lit(0.0)).alias(f"min_{m}"), (F.max(m) + F.lit(0.0)).alias(f"max_{m}")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# The statistics of a column profile, in the order the
# reference's summary() prints them.
PROFILE_STATS = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
DESCRIBE_STATS = ["count", "mean", "stddev", "min", "max"]


def profile(df: DataFrame, measures: list[str], stats: list[str] | None = None,
            digits: int = 6) -> DataFrame:
    """Column profile in long form: one row per statistic, one DOUBLE column
    per measure. Quartiles are exact (distributed selection); the other
    statistics are one aggregate pass, unpivoted by ``stack``."""
    stats = stats or PROFILE_STATS
    qs = [s for s in stats if s.endswith("%")]
    exprs = {
        "count": lambda m: F.count(m).cast("double"),
        "mean": lambda m: F.avg(m),
        "stddev": lambda m: F.round(F.stddev_samp(m), digits),
        "min": lambda m: F.min(m) + F.lit(0.0),
        "max": lambda m: F.max(m) + F.lit(0.0),
    }
    aggs = [exprs[s](m).alias(f"{i}_{j}") for i, s in enumerate(stats) if s in exprs
            for j, m in enumerate(measures)]
    # Quartiles by exact selection (bounded passes); they enter as literals.
    qv = exact_quantiles(df, measures, [float(q[:-1]) / 100 for q in qs]) if qs else {}
    aggs += [F.lit(qv[(m, float(s[:-1]) / 100)]).cast("double").alias(f"{i}_{j}")
             for i, s in enumerate(stats) if s in qs for j, m in enumerate(measures)]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{s}', {i}, " + ", ".join(f"`{i}_{j}`" for j in range(len(measures)))
                     for i, s in enumerate(stats))
    names = ", ".join(["summary", "stat_order"] + [f"`{m}`" for m in measures])
    return wide.selectExpr(f"stack({len(stats)}, {rows}) AS ({names})")


def histogram(df: DataFrame, measure: str, bins: int = 10) -> DataFrame:
    """Equal-width bin counts over the measure's own [min, max] range; the
    last bin is closed. The range is a scalar subquery (computed once)."""
    rng = df.agg(F.min(measure).alias("lo"), F.max(measure).alias("hi"))
    df = df.withColumn("_r", rng.select(F.struct("lo", "hi")).scalar())
    lo, hi = F.col("_r")["lo"], F.col("_r")["hi"]
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col(measure) - lo, width))
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    # The range travels with its bin as grouping keys (one value per bin).
    return (df.filter(F.col(measure).isNotNull())
              .groupBy(b.alias("bin"), lo.alias("lo"), width.alias("width"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_hi"), "n"))
