"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
        "a", F.least("a", "_m").alias("_m"))
    return both.filter("b > a").join(least, "a").select(
        F.col("_m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("_m"))
    moved = links.join(least, "b").select(F.col("_m").alias("a"), F.col("a").alias("b"))
    kept = least.select(F.col("_m").alias("a"), "b")
    return moved.unionByName(kept).filter("a <> b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is either a centre or linked to one centre only."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
        links.select(F.col("b"), F.lit(0), F.lit(1)))
    roles = ends.groupBy("x").agg(F.max("_a").alias("_a"), F.sum("_b").alias("_b"))
    return roles.filter("_a + _b > 1").isEmpty()


def stars(links: DataFrame) -> DataFrame:
    """Links ``a < b`` of numbers, turned into links from each component's smallest number ``a`` to
    every other one ``b``. Large and small stars alternate until nothing else is left; a node with
    very many links is never gathered, only joined and aggregated."""
    state = stored(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(state):
        state = stored(_small_star(_large_star(state)), "links")
    return state
