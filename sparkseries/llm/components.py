"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_sums, kept, signature

MOST_ROUNDS = 100


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links(a, b)`; the component is its smallest node.

    Each step joins links with one row per node, so a node with many links only makes a skewed join, which
    adaptive execution splits. Steps are checkpointed; they end when a round changes nothing. Links of a node
    to itself are dropped.
    """
    stars = kept(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = signature(stars)
    for _round in range(MOST_ROUNDS):
        if before[0] == 0:
            break
        stars = kept(_small_star(_large_star(stars)))
        after = signature(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    ends = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(ends)


def _large_star(stars: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_sums(both.where(F.col("v") > F.col("u")), smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    smallest = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_sums(stars, smallest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
