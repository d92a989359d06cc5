"""Forests as intervals: every node gets the range of its descendants, so a subtree is a range and not a walk.

Nodes are numbered by parent and id, so the children of a node are a range of numbers. Leaves take no part until the end:
pointer doubling over the inner nodes alone gives how much each has below it, and then its place below its root, in a
number of rounds that is the logarithm of the depth. A leaf's place follows from its parent's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import SpecError
from .ranges import numbered, totalled
from .tables import free, stored

#: Places that share a bin of a range join.
BIN = 4096


def forest(parts: list[tuple[str, DataFrame, str, str | None, str | None]]) -> DataFrame:
    """(id, parent, kind) of the rows of several entities as one tree: parts of (kind, rows, key, parent's kind, parent's key).

    Ids are kind and key, as text: "orders:7". Without a parent's kind the rows are roots; a row whose parent's key is NULL is one too.
    """
    made = []
    for kind, rows, key, up, up_key in parts:
        name = lambda k, c: F.concat(F.lit(f"{k}:"), F.col(c).cast("string"))
        made.append(rows.select(name(kind, key).alias("id"), (name(up, up_key) if up else F.lit(None).cast("string")).alias("parent"), F.lit(kind).alias("kind")))
    return reduce(DataFrame.unionByName, made)


def labels(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent") -> tuple[DataFrame, DataFrame]:
    """((id, parent, root, depth, first, last), cyclic ids) of a forest of parent pointers. An id that repeats or is NULL is an error.

    first is a node's number in preorder, over all trees, siblings and roots by id; last is that of its last
    descendant: d lies below x if x.first < d.first <= x.last. A node whose parent is NULL or no node is a root. Nodes
    on or under a cycle have no place; they are reported.
    """
    linked, orphaned = _linked(nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent")))
    if not orphaned.isEmpty():
        # a parent that is no node: its children are roots, in order with the others
        tied = linked.where("at is not null").select("id", "parent").join(orphaned, "parent", "left").select("id", F.when(F.col("orphaned").isNull(), F.col("parent")).alias("parent"))
        again, _ = _linked(tied)
        free(linked)
        linked = again
    # from here on parents are numbers, and leaves wait for the end
    parents = linked.where("child is not null")
    above = parents.select(F.col("id").alias("parent"), F.col("at").alias("above"))
    inner = stored(parents.join(above, "parent", "left").select("at", "above", "child", "kids"), "forest-inner")
    below, cyclic_at = _below(inner)
    # below: a node's descendants. before: those of the inner nodes before it in the order of numbers
    sized = stored(totalled(inner.join(below, "at"), ["at"], F.col("below"), "before"), "forest-sizes")
    # families by their first child; that of the roots, if an inner node is one, has no parent
    kin = sized.groupBy(F.col("above").alias("at")).agg(F.sum("below").alias("of_kids"))
    families = inner.join(below.select("at"), "at").select("at", "child").unionByName(inner.where("above is null").select(F.lit(None).cast("long").alias("at"), F.lit(0).cast("long").alias("child")).limit(1))
    families = families.join(kin, families["at"].eqNullSafe(kin["at"]), "left").select(families["at"], "child", F.coalesce("of_kids", F.lit(0)).alias("of_kids"))
    started = stored(totalled(families, ["child"], F.col("of_kids"), "start").select(F.col("at").alias("above"), F.col("child").alias("from"), "start", "of_kids"), "forest-families")
    # a node's way from its parent's number: itself, its siblings before it and all that these have below them
    step = F.when(F.col("above").isNull(), F.col("at") + F.col("before")).otherwise(1 + F.col("at") - F.col("from") + F.col("before") - F.col("start"))
    steps = sized.join(started.where("above is not null").select("above", "from", "start"), "above", "left").select("at", "above", step.alias("first"))
    ways = _ways(steps)
    named = linked.select("id", "at").join(ways.select(F.col("root_at").alias("at")).distinct(), "at").select(F.col("at").alias("root_at"), F.col("id").alias("root"))
    known = started.where("above is not null").select(F.col("above").alias("at"), "from", "start", "of_kids")
    placed = parents.select("id", "parent", "at").join(ways.join(named, "root_at").join(below, "at").join(known, "at"), "at")
    placed = stored(placed.select("at", "id", "parent", "root", "depth", "first", (F.col("first") + F.col("below")).alias("last"), "from", "start", "of_kids"), "forest-inner-placed")

    # leaves: a leaf takes a place after its siblings before it, and after what these have below them
    leaves = linked.where("child is null").select("id", "parent", "at")
    up = placed.select(F.col("id").alias("parent"), "root", "depth", "first", "from", "start", "of_kids")
    met = leaves.where("parent is not null").join(up, "parent").select("id", "parent", "root", (F.col("depth") + 1).alias("depth"), (F.col("first") + 1 - F.col("from") - F.col("start")).alias("base"), "at", "start", "of_kids")
    met = stored(met, "forest-leaves")
    alone = met.where("of_kids = 0").select("id", "parent", "root", "depth", (F.col("base") + F.col("start") + F.col("at")).alias("first"))
    mixed = met.where("of_kids > 0").select("id", "parent", "root", "depth", "base", "at", F.lit(0).cast("long").alias("below"))
    roots = leaves.where("parent is null").select("id", "parent", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("base"), "at", F.lit(0).cast("long").alias("below"))
    text, whole = leaves.schema["id"].dataType, F.lit(None).cast("long")
    inners = sized.select(F.lit(None).cast(text).alias("id"), F.lit(None).cast(text).alias("parent"), F.lit(None).cast(text).alias("root"), whole.alias("depth"), whole.alias("base"), "at", "below")
    among = totalled(mixed.unionByName(roots).unionByName(inners), ["at"], F.col("below"), "before").where("id is not null")
    among = among.select("id", "parent", "root", "depth", (F.col("base") + F.col("at") + F.col("before")).alias("first"))
    columns = ["id", "parent", "root", "depth", "first", "last"]
    # three tables that are stored, until the process ends
    out = placed.select(*columns).unionByName(alone.unionByName(among).withColumn("last", F.col("first")).select(*columns))
    on_cycles = parents.join(cyclic_at, "at").select("id")
    under = leaves.join(on_cycles.select(F.col("id").alias("parent")), "parent").select("id")
    cyclic = stored(on_cycles.unionByName(under), "forest-cyclic")
    free(linked, inner, below, sized, started, ways, cyclic_at)
    return out, cyclic


def _linked(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, parent, at, child, kids), parents that are no node): at numbers the nodes by parent and id, child is the number of the first child, NULL for a leaf."""
    # siblings in order: neighbours by number, not a window over one parent's children
    ordered = numbered(base, [F.asc_nulls_first("parent"), F.asc("id")], "at")
    family = ordered.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.min("at").alias("child"), F.count("*").alias("kids"))
    # ids are counted before the join, which finds them dealt as it needs them
    linked = stored(ordered.withColumn("same", F.count("*").over(Window.partitionBy("id"))).join(family, F.col("id") == F.col("key"), "full"), "forest-links")
    wrong = linked.where("at is not null and (id is null or same > 1)").select("id").first()
    if wrong is not None:
        raise SpecError(f"a forest needs unique ids: {wrong.id}")
    return linked, linked.where("at is null").select(F.col("key").alias("parent"), F.lit(True).alias("orphaned"))


def _below(inner: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((at, below): how many descendants each inner node has, (at) of those on or under a cycle).

    Pointer doubling: after k rounds a node counts what is less than 2**k levels below it, so the rounds are the logarithm of the depth.
    """
    state = stored(inner.select("at", F.col("above").alias("jump"), F.col("kids").alias("below")), "forest-below")
    most = state.count()
    for k in range(64):
        # no chain is longer than all nodes: what has no end after as many steps is on a cycle
        if 2**k > 2 * most or state.where("jump is not null").isEmpty():
            break
        gained = state.where("jump is not null").groupBy(F.col("jump").alias("at")).agg(F.sum("below").alias("gained"))
        over = state.select(F.col("at").alias("jump"), F.col("jump").alias("next"))
        moved = state.join(over, "jump", "left").join(gained, "at", "left")
        done = stored(moved.select("at", F.col("next").alias("jump"), (F.col("below") + F.coalesce("gained", F.lit(0))).alias("below")), "forest-below")
        free(state)
        state = done
    cyclic = stored(state.where("jump is not null").select("at"), "forest-cyclic-inner")
    below = stored(state.where("jump is null").select("at", "below"), "forest-below")
    free(state)
    return below, cyclic


def _ways(steps: DataFrame) -> DataFrame:
    """(at, first, depth, root_at) of steps(at, above, first), where first counts from the node above: the sums along the way from the root, by pointer doubling."""
    zero = F.lit(0).cast("long")
    state = stored(steps.select("at", F.col("above").alias("jump"), "first", F.when(F.col("above").isNull(), zero).otherwise(zero + 1).alias("depth"), F.coalesce("above", "at").alias("root_at")), "forest-ways")
    while not state.where("jump is not null").isEmpty():
        over = state.select(F.col("at").alias("jump"), F.col("jump").alias("next"), F.col("first").alias("_first"), F.col("depth").alias("_depth"), F.col("root_at").alias("_root"))
        going = state.where("jump is not null").join(over, "jump").select("at", F.col("next").alias("jump"), (F.col("first") + F.col("_first")).alias("first"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_root").alias("root_at"))
        done = stored(state.where("jump is null").unionByName(going), "forest-ways")
        free(state)
        state = done
    return state


def descendants(labelled: DataFrame, of: DataFrame, id_col: str = "id", itself: bool = False, width: int = BIN) -> DataFrame:
    """(ancestor, id, levels) for each node below a node of of(id): a range join in bins of places.

    An ancestor goes to the bins of its range, a node to its own bin, so a bin's work is that of its result.
    """
    wanted = of.select(F.col(id_col).alias("ancestor")).distinct().join(labelled.select(F.col("id").alias("ancestor"), F.col("depth").alias("_depth"), F.col("first").alias("_first"), F.col("last").alias("_last")), "ancestor")
    begin = F.col("_first") + (0 if itself else 1)
    wanted = wanted.where(begin <= F.col("_last")).withColumn("_bin", F.explode(F.sequence(F.floor(begin / width), F.floor(F.col("_last") / width))))
    rows = labelled.select("id", "depth", "first", F.floor(F.col("first") / width).alias("_bin"))
    met = rows.join(wanted, "_bin").where((F.col("first") >= begin) & (F.col("first") <= F.col("_last")))
    return met.select("ancestor", "id", (F.col("depth") - F.col("_depth")).cast("int").alias("levels"))


def subtree_totals(labelled: DataFrame, values: DataFrame, id_col: str, value: str) -> DataFrame:
    """(id, total, rows) of each node: the sum of values(id, value), whole numbers, over it and all below it, and how many nodes these are.

    No pairs are made: the total of a range is what stands before its end less what stands before its start.
    """
    own = values.groupBy(F.col(id_col).alias("id")).agg(F.sum(value).cast("long").alias("_own"))
    rows = totalled(labelled.select("id", "first", "last").join(own, "id", "left").withColumn("_own", F.coalesce("_own", F.lit(0))), ["first"], F.col("_own"), "_before")
    ends = rows.select(F.col("first").alias("last"), (F.col("_before") + F.col("_own")).alias("_upto"))
    # a leaf's total is its own value
    alone = rows.where("first = last").select("id", F.col("_own").alias("total"), F.lit(1).cast("long").alias("rows"))
    return alone.unionByName(rows.where("first < last").join(ends, "last").select("id", (F.col("_upto") - F.col("_before")).alias("total"), (F.col("last") - F.col("first") + 1).alias("rows")))
