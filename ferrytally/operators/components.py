"""Connected components of a graph given by its links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.session import dropping_shuffles, materialise

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it is joined to.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest one, then its smaller ones. Rounds grow with the logarithm of the largest component.
    Each round ends in a reliable checkpoint. Links from a node to itself and repeats are ignored.
    """
    with dropping_shuffles(links.sparkSession):
        edges = materialise(
            links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
        )
    before = None
    for _ in range(MAX_ROUNDS):
        edges = materialise(_smaller_star(_larger_star(edges)))
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _larger_star(edges: DataFrame) -> DataFrame:
    """Links of each node's larger neighbours to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _smaller_star(edges: DataFrame) -> DataFrame:
    """Links of each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
