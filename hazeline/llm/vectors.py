"""Vectors as exact integers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers beyond this would not leave sums of squares exact in 64 bits.
LIMIT = 1 << 24


def usable(vector: Column) -> Column:
    """True for a vector that isn't null or empty and whose components are all
    finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is greater
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as array<int>. A result of 2^24 or
    more in absolute value is an error, not a wrong number."""
    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        said = F.concat(F.lit("component too large for exact sums: "), x.cast("string"))
        return F.when(F.abs(y) < LIMIT, y.cast("int")).otherwise(F.raise_error(said).cast("int"))
    return F.transform(vector, whole)


def integer_vectors(df: DataFrame, vector: str, scale: int, others: list[str]) -> DataFrame:
    """The rows with a usable vector: ``v`` (array<int>), and the other columns."""
    return df.where(usable(F.col(vector))).select(*others, integers(F.col(vector), scale).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
