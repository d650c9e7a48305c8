"""Connected components by repeated local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.store import Store


def components(store: Store, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b longs); component is its smallest node.

    Each round every node moves to whichever of itself and its neighbours has
    the smallest random rank; equal edges merge. A round leaves a fixed fraction
    of the nodes in expectation, so chains and stars alike need a number of
    rounds that is logarithmic in the size of a component. Minima combine on the map side and joins on
    a busy node are left to adaptive skew splitting.
    """
    both = edges.where("a <> b")
    both = both.select("a", "b").union(both.select(F.col("b"), F.col("a"))).distinct()
    graph = store.put(both, "edges")
    moved = store.put(graph.select(F.col("a").alias("node"), F.col("a").alias("at")).distinct(), "nodes")
    seed = 0
    while not graph.isEmpty():
        seed += 1
        rank = lambda c, s=seed: F.struct(F.xxhash64(F.col(c), F.lit(s)), F.col(c))
        least = graph.groupBy("a").agg(F.min(rank("b")).alias("m"))
        own = rank("a")
        step = store.put(
            least.select("a", F.least(F.col("m"), own.cast(least.schema["m"].dataType)).alias("m")).select(
                "a", F.col("m").getField("b").alias("to")
            ),
            "step",
        )
        to = step.withColumnRenamed("a", "_x")
        following = (
            graph.join(to.withColumnRenamed("to", "_a"), F.col("a") == F.col("_x"))
            .select("_a", "b")
            .join(to.withColumnRenamed("to", "_b"), F.col("b") == F.col("_x"))
            .where("_a <> _b")
            .select(F.col("_a").alias("a"), F.col("_b").alias("b"))
            .distinct()
        )
        placed = moved.join(to, F.col("at") == F.col("_x"), "left").select(
            "node", F.coalesce("to", "at").alias("at")
        )
        old = (graph, moved, step)
        graph, moved = store.put(following, "edges"), store.put(placed, "nodes")
        for table in old:
            store.drop(table)
    least = moved.groupBy("at").agg(F.min("node").alias("component"))
    return moved.join(least, "at").select("node", "component")
