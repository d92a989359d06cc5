"""Connected components by contraction, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges(a, b): comp is the smallest node of its component.

    A round hooks each node of the contracted graph to its smallest neighbour, follows the hooks to their
    roots, and contracts. Every pass is a join and a min with partial aggregation: a node with very many
    edges costs a row a task. Self-loops only name a node. Null ends are dropped.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    label = nodes.withColumn("comp", F.col("node"))
    live = stored(_canonical(edges), "cc-edges")
    while not live.isEmpty():
        # hooks(node, root): smallest neighbour where that is smaller, and their targets as roots
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up")), "cc-hooks")
        held = hooks
        while True:  # hooks lead to smaller nodes only, so doubling their length ends
            over = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            longer = stored(hooks.join(over, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "cc-hooks")
            free(held)
            held, hooks = longer, longer.select("node", "up")
            if longer.where("moved").isEmpty():
                break
        up = hooks.select(F.col("node").alias("comp"), "up")
        before, label = label, stored(label.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "cc-labels")
        to_a, to_b = hooks.toDF("a", "ua"), hooks.toDF("b", "ub")
        contracted = stored(_canonical(live.join(to_a, "a").join(to_b, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))), "cc-edges")
        free(before, held, live)
        live = contracted
    free(live)
    return label


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
