"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of each node, and itself, to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every node point to one root, and no root to anything? Then the edges are stars."""
    ends = F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")), F.struct(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    per = edges.select(F.explode(ends).alias("x")).groupBy("x.n").agg(F.sum("x.out").alias("out"), F.max("x.in").alias("in"))
    return not per.where("out > 1 or (out = 1 and in = 1)").head(1)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (u, v): component is the smallest
    node reachable. Each round's edges are written to the shared folder."""
    edges = edges.select("u", "v").where("u != v")
    while True:
        edges = materialise(_small_star(_large_star(edges)))
        if _settled(edges):
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
