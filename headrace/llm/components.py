"""Connected components by alternating stars, as joins and sums over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node reachable from it.

    Each round ties every node's larger neighbours to its smallest one, then its smaller ones. Rows
    never outnumber the edges, rounds grow with the logarithm of the longest chain. A node with very
    many neighbours costs rows, not memory: its smallest neighbour is a map-side minimum and is
    joined back. Every round ends in a written table, so a lost executor costs one round.
    """
    edges = stored(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        edges = stored(
            both.join(low, "a").where("b > a").select(F.col("low").alias("a"), "b").where("a < b").distinct(), "large-star"
        )
        small = edges.groupBy("b").agg(F.min("a").alias("low"))
        tied = edges.join(small, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("low").alias("a"))
        edges = stored(tied.where("a < b").select("a", "b").distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(roots)
