"""Connected components by alternating large-star and small-star steps, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the smallest node of its neighbourhood."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    smaller = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return smaller.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; edges have columns a, b (long). The component is its smallest node.

    Loops, repeated edges and edges with a NULL end add nothing. Each round is stored, so lineage stays short. The rounds end
    when the edges are stars: every node points to one node, which points nowhere. Nothing but one number goes to the driver.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "components")
    while True:
        current = stored(small_star(large_star(current)), "components")
        roots = current.select(F.col("lo").alias("hi")).distinct()
        several = current.groupBy("hi").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hi")
        if current.join(roots, "hi", "left_semi").select("hi").unionAll(several).isEmpty():
            break
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
