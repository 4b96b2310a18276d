"""Candidate pairs of buckets without all pairs of a bucket.

Buckets are rows (key, node, component). Each member is compared with one hub
of its bucket; members that end up in one component need no more comparisons,
so only pairs from different components are left for a last, blocked round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import materialize


def unresolved(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with more than one component. ``found`` has node and
    component; a node that isn't in it is its own component."""
    placed = (buckets.drop("component").join(found, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a <> b").select("key"))
    return materialize(placed.join(mixed, "key"), "unresolved")


def hub_pairs(buckets: DataFrame, order: Column) -> DataFrame:
    """u < v: every member with its bucket's hub, the member first in ``order``
    (then the least), if their components differ. The hub's choice is a grouped
    minimum, combined before the shuffle."""
    first = F.min(F.struct(order.alias("o"), F.col("node").alias("hub"), F.col("component").alias("of")))
    hub = buckets.groupBy("key").agg(first.alias("h")).select("key", "h.hub", "h.of")
    both = buckets.join(hub, "key").where("component <> of")
    return both.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()
