"""Connected components of an edge table by alternating star contraction; no component is ever held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskb.llm.store import materialize


def _contract(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step: every node hands the least of its neighbours and itself on to its neighbours."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = near.join(least, "u")
    if both_ways:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component's name is its least node.

    ``edges`` has two integer columns a and b; order, repeats and loops don't matter.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = materialize(edges, "edges")
    state = None
    while True:
        # each node below has edges to smaller ones only
        edges = materialize(_contract(_contract(edges, True), False), "edges")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
