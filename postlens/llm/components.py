"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import saved


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and all v that u is paired with."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b); the root is the component's least node.

    Large and small stars in turn: each node hands its larger, then its smaller
    neighbours to the least node it knows, which flattens a component to a star in about
    the logarithm of its size. Stars are joined, never collected: a node with very many
    neighbours is a skewed key that adaptive execution splits.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = saved(pairs, "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        stars = _with_least(large)
        small = stars.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            stars.select("u", F.col("m").alias("v"))
        )
        new = saved(small.filter("u <> v").distinct(), "edges")
        pairs = new
        # Flat: no node with a root is a root itself, and none has two.
        roots = pairs.select(F.col("v").alias("u")).distinct()
        if pairs.join(roots, "u", "left_semi").isEmpty() and pairs.groupBy("u").count().filter("count > 1").isEmpty():
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
