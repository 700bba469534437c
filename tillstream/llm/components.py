"""Connected components of a graph of long ids, by alternating stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.session import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour, or to the node itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _least_neighbour(both).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _least_neighbour(down)
    moved = down.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(near.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, u: str, v: str, label: str = "label") -> DataFrame:
    """(`u`, `label`) for every node that has an edge: the least node it can reach.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the
    longest chain. Nulls and loops count as no edge. Only two numbers reach the driver.
    """
    edges = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct()
    seen = None
    while True:
        edges = stage(_small_star(_large_star(edges)).distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ends = edges.select("v").distinct().select(F.col("v").alias("u"), "v")
    return edges.union(ends).select(F.col("u").alias(u), F.col("v").alias(label))
