"""Connected components of links, as a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.session import stored


def _stars(edges: DataFrame) -> bool:
    """Whether each node is linked with one lesser node only, which has no lesser one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("lesser"), F.lit(0).alias("greater"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("lesser"), F.lit(1).alias("greater")))
    ends = ends.groupBy("node").agg(F.sum("lesser").alias("lesser"), F.max("greater").alias("greater"))
    return ends.filter((F.col("lesser") > 1) | (F.col("lesser") + F.col("greater") > 1)).isEmpty()


def _towards_least(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """Link (x, least neighbour of u) for each neighbour x of u."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("b"))
    return near.join(least, "u").select(F.col("v").alias("a"), "b").filter("a != b")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that links (a, b) reach, for every node that has a link.

    Large star and small star by turns, until each node is linked with the least one only, which
    is told from the links, not from a turn that changes nothing.  A
    node with very many links is one row of an aggregate; the rows joined to it are dealt anew
    at run time where they are skewed.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = stored(edges, "links")
    while not _stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _towards_least(both, both.filter("v > u"))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b")
        small = small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(small.distinct(), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
