"""Connected components of a table of links by alternating large-star and
small-star steps. Each step is one grouped minimum (combined before the
shuffle) and one join; a node with very many links is spread by the skew
handling of that join. Every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import discard, materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v"))


def _stars(edges: DataFrame) -> bool:
    """True if each link's larger end has that one link only, and no node is the
    larger end of one and the smaller of another."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    return (ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 or (up = 1 and down = 1)").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """Of links (u, v: long): node, component, where component is the least node
    that can be reached. Null ends and loops are ignored; repeated links don't
    matter; no links, no rows."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(edges.where("u <> v").distinct(), "links")
    while not _stars(edges):
        before, edges = edges, materialize(small_star(large_star(edges)).distinct(), "stars")
        discard(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
