"""Division-safe, error-free numeric expressions for ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unify_null(c: Column) -> Column:
    """NaN becomes NULL, so averages, maxima and comparisons skip it."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c: Column | str) -> Column:
    """Text as DOUBLE. Malformed text, NaN and infinities become NULL: none of
    them is a reading, and one infinite value would take a mean with it."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.try_cast("double")
    return F.when(F.abs(v) < float("inf"), v)


def rounded(c: Column | str, digits: int = 6) -> Column:
    """A result rounded for display or comparison. The nudge lies far below the
    last digit kept, so exact halves fall the same way whatever the order of a
    sum; adding zero turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(10.0 ** -(digits + 3)), digits) + F.lit(0.0)


def pairwise_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson r over rows where both are present; NULL (not an error) when
    either side is constant. Spark's ``corr`` raises DIVIDE_BY_ZERO under
    ANSI and a ``when`` guard does not help because both branches run."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    x = F.when(b.isNotNull(), a)
    y = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
