"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for links (a long, b long): the smallest node that links lead to, for each node with a link.

    In each round every node's larger neighbours are linked to its smallest one, then its smaller ones; this ends, after
    a number of rounds that grows with the logarithm of the longest path, when every node is linked to its component. Links stay narrow rows of Spark;
    a node with very many of them is divided by Spark's skew join, and each round is written to the shared folder. Nulls and links to itself are left out.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.join(least, "u").filter(F.col("v") > F.col("u"))
        edges = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        smaller = edges.join(least, "u")
        edges = smaller.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = edges.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct()
        edges = stored(edges, "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select("v", "v").distinct())
