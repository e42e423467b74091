"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridshard.llm.common import discard, written


def _linked_to_least(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node, larger ones or smaller ones, to the least of node and neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Written: a join of two plain shuffles is one that adaptive execution can split at a node with many links.
    least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the least node that links lead to.

    Rounds end when the edges stay the same; their number grows with the logarithm of the longest
    path. Every round is written, and a node with many links is only ever aggregated and joined.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while mark[0]:
        before, edges = edges, written(_linked_to_least(_linked_to_least(edges, True), False), "edges")
        discard(before)
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
