"""Connected components of a large graph by random contraction.

Every round each vertex joins the neighbour (or itself) whose hash is smallest in that
round, and the graph is rewritten in terms of the joined vertices. The order is new in
every round, so the number of vertices falls by a constant factor whatever the shape of the
graph, chains included. The rounds' assignments are then composed. All steps are joins
and aggregates with a map-side part; a vertex with very many neighbours never has them in one
place, and joins on such a vertex are left to the adaptive skew split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two long columns): equal roots are one component.

    The root is some member of the component. Loops and repeated edges are allowed. Rounds are
    written to the shared folder, so a lost executor repeats at most the round at hand.
    """
    a, b = edges.columns
    graph = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    graph = written(graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    rounds = []
    while not graph.isEmpty():
        rank = lambda c: F.xxhash64(F.col(c), F.lit(len(rounds)))
        best = F.min(F.struct(rank("b").alias("h"), F.col("b").alias("to")))
        chosen = graph.groupBy("a").agg(best.alias("best")).select(
            F.col("a").alias("node"),
            F.when(F.col("best") < F.struct(rank("a").alias("h"), F.col("a").alias("to")), F.col("best.to"))
            .otherwise(F.col("a")).alias("root"))
        chosen = written(chosen, "roots")
        rounds.append(chosen)
        half = graph.join(chosen, F.col("a") == F.col("node")).select(F.col("root").alias("a"), "b")
        moved = half.join(chosen, F.col("b") == F.col("node")).select("a", F.col("root").alias("b"))
        graph = written(moved.filter("a <> b").distinct(), "edges")
    if not rounds:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("root"))
    result = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        result = result.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return result


def smallest_member(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, component, first`` for every row of ``nodes`` (``node`` unique, ``first`` its smallest id).

    ``component`` is equal within a component; ``first`` becomes the smallest non-null one of it.
    """
    labelled = written(
        nodes.join(components(edges), "node", "left")
        .select("node", "first", F.coalesce("root", "node").alias("component")), "labels")
    least = labelled.groupBy("component").agg(F.min("first").alias("first"))
    return labelled.drop("first").join(least, "component").select("node", "component", "first")
