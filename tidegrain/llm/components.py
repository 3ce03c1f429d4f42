"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the undirected edges (u, v); root is the smallest node reachable.

    Each round links the larger neighbours of a node, then the smaller ones, to the smallest neighbour. The number of edges
    never grows and depth shrinks geometrically, so a chain of n nodes takes O(log n) rounds. Rounds are written tables.
    Loops, repeated edges and rows with a null end are ignored; no edges give no rows.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        edges = written(
            linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
