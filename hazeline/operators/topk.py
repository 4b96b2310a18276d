"""The first k rows of each key in an order.

Rows of a key are cut to k in each task, then in each of some parts that they are
dealt to, then as a whole: a key that holds a third of all rows sends k rows from
each task, and the last step sees k rows of each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a key's rows that are cut apart.
PARTS = 64


def top_k(df: DataFrame, keys: list[str], order: list[str], k: int, with_ties: bool = False) -> DataFrame:
    """The first k rows of each key (of all rows, without keys) in an order of
    column names, each perhaps followed by " desc"; nulls come last. Rows equal in
    it that don't all fit are an arbitrary choice, unless the order is total; with
    ``with_ties`` all rows equal to the k-th are kept, too. Null keys are a key."""
    names = [o.partition(" ")[::2] for o in order]
    by = [(F.desc_nulls_last if way.strip() == "desc" else F.asc_nulls_last)(f"row.`{c}`") for c, way in names]
    place = F.rank() if with_ties else F.row_number()
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
                     F.struct(*(F.col(f"`{c}`") for c in keys) if keys else [F.lit(0).alias("all")]).alias("k"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*(F.col(f"row.`{c}`") for c in df.columns)), F.lit(PARTS)))
    for window in (Window.partitionBy("k", "part"), Window.partitionBy("k")):
        rows = rows.withColumn("place", place.over(window.orderBy(*by))).where(F.col("place") <= k).drop("place")
    return rows.select("row.*")
