"""Connected components of an edge table by alternating large-star and small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014). Nodes may be of any
type that Spark orders. A node with many neighbours is a hot key of a join whose other side
has one row per node, which adaptive execution splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, files_for


# Edges (a, b) have a > b throughout.

def _large_star(e: DataFrame, files: int) -> DataFrame:
    """Every node's larger neighbours go to the smallest of the node and its neighbours."""
    # a table of its own, so that the edges of a node with many larger neighbours can be split
    low = checkpoint(e.groupBy("a").agg(F.min("b").alias("m")).coalesce(files)).select(F.col("a").alias("b"), "m")
    return e.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    hung = e.join(low, "a").filter(F.col("b") != F.col("m")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(e: DataFrame) -> bool:
    """Whether every node has one edge up at most, and none if it has one from below: then
    each component is a star around its smallest node."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    mixed = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))
    return mixed.count() == 0


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is its component's smallest node.
    ``files`` are those that the edges are written to at first, if their number is known."""
    first = edges.filter(F.col("a") != F.col("b")) \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = checkpoint(first.coalesce(files) if files else first)
    files = files_for(e.count())  # a round never adds edges
    while not _is_stars(e):
        e = checkpoint(_small_star(_large_star(e, files)).coalesce(files))
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
