"""The next lower id of every id, without one global sort.

Ids are grouped by their high bits; inside a group a window gives each id the
next lower one. Only the least id of each group is open then, and groups are
themselves grouped by higher bits, level by level, until one is left. The least
id of all is followed by the greatest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import materialize

BITS = 12


def next_lower(ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Of the distinct non-null ids: id, next_id. A lone id follows itself."""
    own = F.col(column).cast("long")
    level = ids.where(own.isNotNull()).select(own.alias("key"), own.alias("lo"), own.alias("hi")).distinct()
    parts = []
    for depth in range(-(-64 // BITS) + 1):
        # Past the last bits negative and other ids still make two groups.
        parent = F.expr(f"shiftright(key, {BITS})") if depth < -(-64 // BITS) - 1 else F.lit(0).cast("long")
        level = materialize(level.withColumn("parent", parent), "ring")
        lower = F.lead("hi").over(Window.partitionBy("parent").orderBy(F.desc("key")))
        parts.append(level.select(F.col("lo").alias("id"), lower.alias("next_id")).where("next_id is not null"))
        level = level.groupBy("parent").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).withColumnRenamed("parent", "key")
        if len(level.take(2)) < 2:
            break
    out = level.select(F.col("lo").alias("id"), F.col("hi").alias("next_id"))
    for p in parts:
        out = out.union(p)
    return out
