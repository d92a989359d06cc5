"""Trees kept as parent pointers: levels, paths and owners, safe against cycles.

Each step joins the frontier with the edges; a step's rows are the next level only, so the work is the
number of edges times the steps a node is reached in. The loop is bounded by the tree's depth.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def descend(nodes: DataFrame, roots: DataFrame, id_col: str, parent_col: str, levels: int | None = None) -> DataFrame:
    """(id, level, root) of each node below the roots, which have level 0; each node once, at its smallest level.

    levels bounds the depth. A cycle is walked once: a node that was reached is not reached again. A node under
    several roots at the same level takes the smallest. Null parents lead nowhere.
    """
    edges = nodes.select(F.col(id_col).alias("child"), F.col(parent_col).alias("up")).where("up is not null")
    done = front = stored(roots.select(F.col(id_col).alias("id")).distinct().select("id", F.lit(0).alias("level"), F.col("id").alias("root")), "tree")
    for level in count(1) if levels is None else range(1, levels + 1):
        reached = edges.join(front, F.col("up") == F.col("id")).groupBy("child").agg(F.min("root").alias("root"))
        front = stored(reached.select(F.col("child").alias("id"), F.lit(level).alias("level"), "root").join(done.select("id"), "id", "left_anti"), "tree")
        if front.isEmpty():
            break
        done = done.unionByName(front)
    return done.withColumnRenamed("id", id_col)


def owners(nodes: DataFrame, owned: DataFrame, id_col: str, parent_col: str) -> tuple[DataFrame, DataFrame]:
    """(owner rows, cyclic rows). Each node belongs to its topmost ancestor that is owned(id, owner), itself included.

    Pointer doubling: after k rounds a node knows the topmost owned of 2**k ancestors, so the rounds are the
    logarithm of the depth. Nodes that never come to a root lie on or under a cycle; they are reported and have no owner.
    """
    base = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"))
    known = base.select(F.col("id").alias("known"))
    # a parent that is no node ends the chain
    base = base.join(known, F.col("up") == F.col("known"), "left").select("id", F.col("known").alias("up"))
    at = stored(base.join(owned.select(F.col("id"), F.col("owner")), "id", "left").select("id", "up", F.col("owner").alias("top")), "owners")
    most = at.count()
    for k in range(64):
        # on a cycle pointers never end, while no chain of a forest is longer than its nodes
        if at.where("up is not null").isEmpty() or 2**k > 2 * most:
            break
        over = at.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("top").alias("higher"))
        at = stored(at.join(over, "up", "left").select("id", F.col("next").alias("up"), F.coalesce("higher", "top").alias("top")), "owners")
    cyclic = at.where("up is not null").select(F.col("id").alias(id_col))
    return at.where("up is null and top is not null").select(F.col("id").alias(id_col), F.col("top").alias("owner")), cyclic


def path_prefixes(paths: DataFrame, column: str, separator: str = "/") -> DataFrame:
    """(path, name, parent_path, level, is_leaf): each distinct prefix of slash paths; a leaf is a whole path."""
    parts = F.split(F.col(column), separator)
    rows = paths.where(F.length(column) > 0).select(parts.alias("parts"), F.posexplode(parts).alias("at", "name"))
    join = lambda n: F.array_join(F.slice("parts", 1, n), separator)
    rows = rows.select(
        join(F.col("at") + 1).alias("path"), "name", F.when(F.col("at") > 0, join(F.col("at"))).alias("parent_path"), F.col("at").alias("level"), (F.col("at") == F.size("parts") - 1).alias("leaf")
    )
    return rows.groupBy("path", "name", "parent_path", "level").agg(F.bool_or("leaf").alias("is_leaf"))
