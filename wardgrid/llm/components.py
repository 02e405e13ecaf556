"""Connected components by alternating stars, in rounds of joins; no component is held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b, both long); root is the least node reachable."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        large = staged(_large_star(edges), "large")
        edges = staged(_small_star(large), "small")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root; other nodes are their own root) after more links: only what these join is traversed."""
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    moved = staged(components(between).select(F.col("node").alias("root"), F.col("root").alias("to")), "moved")
    known = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = moved.select(F.col("root").alias("node"), F.col("to").alias("root")).join(roots.select("node"), "node", "left_anti")
    return known.unionByName(new)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger node has one edge and no node is the larger and the smaller end of edges."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("other"))
    return larger.join(least, "a").select(F.col("other").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the least of them."""
    least = staged(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
