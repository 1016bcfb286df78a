"""Connected components by alternating large-star and small-star steps.

Each step replaces links by links to smaller neighbours.  When every node is
either a centre or linked to one centre alone, the stars are the components.
A step is one pre-aggregated minimum per node and one join on the node, so a
node with very many links is combined before the shuffle and split by the
adaptive skew join after it.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _large_star(links: DataFrame) -> DataFrame:
    """A node's larger neighbours go to its smallest neighbour (or itself)."""
    near = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    """links hold a < b: b's smaller neighbours and b itself go to their minimum."""
    low = links.groupBy("b").agg(F.min("a").alias("m"))
    both = F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))
    return links.join(low, "b").select(F.inline(both)).where("a < b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """No node is linked to two smaller ones, or to a smaller and a larger one."""
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("centre"), F.lit(0).alias("leaf")),
                                         F.struct(F.col("b").alias("node"), F.lit(0).alias("centre"), F.lit(1).alias("leaf")))))
    roles = ends.groupBy("node").agg(F.max("centre").alias("centre"), F.sum("leaf").alias("leaf"))
    return roles.where("centre + leaf > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest
    node reachable.  links: two long columns a, b; self-links, repeats and
    either direction are allowed, null ends are ignored.  No links: no rows."""
    links = stored(links.where("a is not null and b is not null and a <> b")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(links):
        links = stored(_small_star(_large_star(links)), "stars")
    return (links.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()))
