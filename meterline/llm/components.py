"""Connected components by alternating large and small stars, on tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """Least node reachable from each node of ``links(a, b)``: rows ``(node, root)``.

    Works for any node type with an order. Each round takes minima that combine
    before the shuffle, and joins that adaptive execution can split, so a node
    with a very large number of links is not gathered anywhere. Ends when a
    round changes nothing. Nulls and self-links are left out.
    """
    edges = pin(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = pin(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = pin(small.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    root = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
