"""Connected components by alternating stars.

Every round hangs the larger neighbours of a node on the smallest node around it (large star), then the smaller ones and the
node itself (small star), until nothing changes and every node hangs on the smallest of its component. Rounds grow with the
logarithm of the component size, chains included. A node with very many neighbours is only an aggregate and a join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import written


def _least(edges: DataFrame) -> DataFrame:
    """The smaller of each node and its smallest neighbour, for edges given from both ends."""
    return edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns of one type): the root is the smallest node of the component.

    Loops and repeated edges are allowed. Rounds are written to the shared folder.
    """
    a, b = edges.columns
    graph = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    state = _state(graph)
    while True:
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "edges")
        small = large.join(_least(large), "u")
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        graph = written(hung, "edges")
        before, state = state, _state(graph)
        if state == before:
            break
    roots = graph.select("v").distinct()
    return graph.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
