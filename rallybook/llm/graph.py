"""Connected components of an edge table."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from rallybook.sources.scratch import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """`node` and `label`, the smallest node that it is connected with, for every node with an edge.

    Edges are pairs (a, b) of bigints in any order. Large and small stars alternate until nothing
    changes; each round is written to `folder`, so that a lost executor costs one round.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        edges = stored(edges, f"{folder}/edges-{uuid4().hex}")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select("b", "b").distinct()
            )
        before, edges = now, small_star(large_star(edges))
