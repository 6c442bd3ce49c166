"""Connected components of an edge table, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import stage

MOST_ROUNDS = 200  # a graph of 10^12 nodes takes some forty

def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``; equal labels are linked.

    Every round points each node at the first of itself and its neighbours, in an order
    drawn anew per round, and contracts the graph along the pointers. The order by hash
    makes the graph shrink by a constant factor in expectation whatever its shape, so the
    rounds grow with the logarithm of the input. A hub meets its neighbours in partial
    minima. Each round is written to the shared folder, where it ends its lineage.
    """
    spark = edges.sparkSession
    kind = edges.schema["a"].dataType.simpleString()
    labels = None
    for turn in range(MOST_ROUNDS):
        edges = stage(edges.filter("a <> b").distinct(), "edges")
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        order = F.struct(F.xxhash64(F.lit(turn), F.col("b")), F.col("b"))
        nearest = both.groupBy("a").agg(F.min(order)["b"].alias("b"))
        mine = F.struct(F.xxhash64(F.lit(turn), F.col("a")), F.col("a"))
        theirs = F.struct(F.xxhash64(F.lit(turn), F.col("b")), F.col("b"))
        step = stage(nearest.select("a", F.when(theirs < mine, F.col("b")).otherwise(F.col("a")).alias("to")), "step")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            moved = labels.join(step, labels["label"] == step["a"], "left")
            labels = moved.select("node", F.coalesce("to", "label").alias("label"))
        labels = stage(labels, "labels")
        left = edges.join(step, "a").select(F.col("to").alias("x"), "b")
        right = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = left.join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    else:
        raise RuntimeError("the edges have not contracted")
    if labels is None:
        return spark.createDataFrame([], f"node {kind}, label {kind}")
    return labels
