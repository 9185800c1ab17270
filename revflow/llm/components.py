"""Connected components of an edge table, by alternating stars.

Each round points the larger neighbours of a node at its smallest neighbour,
then the smaller ones; rounds grow with the logarithm of the longest path. Per
node only a minimum is kept and edges are dealt out by node with adaptive skew
handling, so a node with many neighbours needs no task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.tables import stored


def _least(edges: DataFrame) -> DataFrame:
    """u, v and the smallest of u and its neighbours as m."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of a table ``a, b`` of edges; the component is its smallest node."""
    edges = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # each edge now runs from the larger to the smaller node
        small = _least(large)
        after = stored(
            small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct(),
            "edges",
        )
        if not _changed(edges, after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        edges = after


def _changed(before: DataFrame, after: DataFrame) -> bool:
    def digest(df: DataFrame):
        return df.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    return digest(before) != digest(after)
