"""Identity matching, scope and coverage: two collections compared without guessing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def cascade_match(left: DataFrame, right: DataFrame, keys: list[str], id_col: str, pos_col: str) -> DataFrame:
    """(left_id, right_id, matched_by): passes over keys in order, one partner each, unmatched rows of both sides at the end.

    A pass looks at rows that no earlier pass consumed. A right key that several free rows share matches nothing; of
    several left rows with one key the first by pos_col wins. NULL and empty keys match nothing. Hot keys don't gather
    rows: right keys are counted and left keys take a minimum, both by partial aggregation.
    """
    free_left, free_right = left, right
    matches = []
    for key in keys:
        usable = lambda df: df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))  # noqa: E731, B023
        single = usable(free_right).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"), F.min(id_col).alias("right_id")).where("n = 1")
        first = usable(free_left).groupBy(F.col(key).alias("k")).agg(F.min(F.struct(pos_col, id_col)).alias("first"))
        found = stored(first.join(single, "k").select(F.col(f"first.{id_col}").alias("left_id"), "right_id", F.lit(key).alias("matched_by")), f"match-{key}")
        matches.append(found)
        free_left = free_left.join(found.select(F.col("left_id").alias(id_col)), id_col, "left_anti")
        free_right = free_right.join(found.select(F.col("right_id").alias(id_col)), id_col, "left_anti")
    kind = {side: df.schema[id_col].dataType for side, df in (("l", left), ("r", right))}
    rest = [
        free_left.select(F.col(id_col).alias("left_id"), F.lit(None).cast(kind["r"]).alias("right_id"), F.lit(None).cast("string").alias("matched_by")),
        free_right.select(F.lit(None).cast(kind["l"]).alias("left_id"), F.col(id_col).alias("right_id"), F.lit(None).cast("string").alias("matched_by")),
    ]
    return reduce(DataFrame.unionByName, [*matches, *rest])


def _grams(c: str, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(F.col(c), i, F.lit(n)))


def pair_by_name(left: DataFrame, right: DataFrame, name_col: str, id_col: str, declared: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id, how) of artifacts whose folded names are equal, one a prefix of the other, or contain each other.

    Where one name contains another, it has all its trigrams: names meet at the shorter one's rarest, or, under three characters, at
    itself, and the texts decide. So a name makes rows in proportion to its length. declared(left_id, right_id) pairs come first.
    """
    l, r = left.select(F.col(id_col).alias("left_id"), F.col(name_col).alias("ln")).where("length(ln) > 0"), right.select(F.col(id_col).alias("right_id"), F.col(name_col).alias("rn")).where("length(rn) > 0")

    def grams(df: DataFrame, c: str, sizes: tuple[int, ...]) -> DataFrame:
        each = [_grams(c, n) for n in sizes]
        each = [F.when(F.length(c) >= n, e).otherwise(F.array().cast("array<string>")) for n, e in zip(sizes, each, strict=True)]
        return df.withColumn("gram", F.explode(F.array_distinct(F.concat(*each))))

    def within(long: DataFrame, lc: str, short: DataFrame, sc: str) -> DataFrame:
        """Pairs in which the long name holds the short one."""
        held = grams(long, lc, (1, 2, 3))
        often = held.groupBy("gram").agg(F.count("*").alias("n"))
        names = short.select(sc).distinct()
        rare = grams(names.where(F.length(sc) > 3), sc, (3,)).join(often, "gram").groupBy(sc).agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
        keyed = short.join(names.where(F.length(sc) <= 3).select(sc, F.col(sc).alias("gram")).unionByName(rare), sc)
        return held.join(keyed, "gram").where(F.contains(F.col(lc), F.col(sc))).drop("gram")

    columns = ["left_id", "ln", "right_id", "rn"]
    inside = within(l, "ln", r, "rn").select(*columns).unionByName(within(r, "rn", l, "ln").select(*columns))
    front = F.startswith("ln", "rn") | F.startswith("rn", "ln")
    rank = F.when(F.col("ln") == F.col("rn"), 1).when(front, 2).otherwise(3)
    found = inside.select("left_id", "right_id", rank.alias("rank"))
    if declared is not None:
        found = found.unionByName(declared.select("left_id", "right_id", F.lit(0).alias("rank")))
    names = F.element_at(F.array(*map(F.lit, ("declared", "exact", "prefix", "contains"))), F.col("rank") + 1)
    return found.groupBy("left_id", "right_id").agg(F.min("rank").alias("rank")).select("left_id", "right_id", names.alias("how"))


def scope(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """One row: how two id sets relate (exact, partial, disjoint or unknown), with counts of both sides and of shared ids.

    A side without any id is unknown, not empty.
    """
    sides = left.select(F.col(id_col).alias("id"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(F.col(id_col).alias("id"), F.lit(0).alias("l"), F.lit(1).alias("r")))
    per = sides.where("id is not null").groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    n = per.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"), F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_shared"))
    kind = (
        F.when((F.col("n_left") == 0) | (F.col("n_right") == 0), "unknown")
        .when((F.col("n_shared") == F.col("n_left")) & (F.col("n_shared") == F.col("n_right")), "exact")
        .when(F.col("n_shared") > 0, "partial")
        .otherwise("disjoint")
    )
    return n.withColumn("scope", kind)


def within_scope(rows: DataFrame, shared_roots: DataFrame, root_col: str) -> DataFrame:
    """Rows under roots that both sides have: what a partial scope may compare."""
    return rows.join(shared_roots.select(F.col(shared_roots.columns[0]).alias(root_col)).distinct(), root_col, "left_semi")


def compare(matches: DataFrame) -> DataFrame:
    """matches with verdict: matched, missing (left only) or extra (right only)."""
    verdict = F.when(F.col("right_id").isNull(), "missing").when(F.col("left_id").isNull(), "extra").otherwise("matched")
    return matches.withColumn("verdict", verdict)


def compatibility(compared: DataFrame, scope_kind: str, weak: tuple[str, ...] = ("caption",)) -> DataFrame:
    """Per concept and overall: matched, total of the left side, and the percentage to one decimal.

    compared(concept, matched_by, verdict). The percentage is NULL outside an exact scope, and where weak matches
    are more than half of a concept's.
    """
    by = compared.where("verdict <> 'extra'").groupBy("concept").agg(
        F.count_if(F.col("verdict") == "matched").alias("matched"), F.count("*").alias("total"), F.count_if(F.col("matched_by").isin(*weak)).alias("weak")
    )
    sure = (F.lit(scope_kind) == "exact") & (F.col("weak") * 2 <= F.col("matched")) & (F.col("total") > 0)
    return by.select("concept", "matched", "total", F.when(sure, F.round(100 * F.col("matched") / F.col("total"), 1)).alias("percent"))


def coverage(n: Column) -> Column:
    """yes, no or unknown of a count that may be unknown."""
    return F.when(n > 0, "yes").when(n == 0, "no").otherwise("unknown")


def difference_kind(kind: Column, scope_kind: Column, near: Column) -> Column:
    """What a difference is worth: real, out of scope, or perhaps a change between builds."""
    return (
        F.when(scope_kind.isin("disjoint", "unknown"), "notComparable")
        .when((scope_kind == "partial") & kind.isin("missing", "extra"), "outsideScopePossible")
        .when(~near, "versionDrift")
        .otherwise(F.when(kind == "matched", "none").otherwise("difference"))
    )


def set_variance(rows: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """(item, groups, always): in how many groups an item occurs, and whether in all."""
    n = rows.agg(F.count_distinct(group_col).alias("n"))
    per = rows.groupBy(F.col(item_col).alias("item")).agg(F.count_distinct(group_col).alias("groups"))
    return per.crossJoin(F.broadcast(n)).select("item", "groups", (F.col("groups") == F.col("n")).alias("always"))


def first_clash(scopes: DataFrame, id_col: str, entries_col: str, pos_col: str) -> DataFrame:
    """(id, other, entry): for each task its first clash with a task before it over a scope entry.

    Tasks under one entry are told apart by the entry's first task alone: every later one clashes with it, so no pairs are made.
    """
    e = scopes.select(F.col(id_col).alias("id"), F.col(pos_col).alias("pos"), F.explode(F.array_distinct(entries_col)).alias("entry"))
    heads = e.groupBy("entry").agg(F.min(F.struct("pos", "id")).alias("head"))
    hit = e.join(heads, "entry").where("head.id <> id")
    first = hit.groupBy("id").agg(F.min(F.struct(F.col("head.pos").alias("pos"), F.col("head.id").alias("other"), "entry")).alias("c"))
    return first.select("id", "c.other", "c.entry")


def ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in order; groups must be small enough for one task."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def ranked_first(df: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """(key, first): the most smallest distinct values of each key, sorted; a frequent key never gathers in one task.

    Values are dealt into slices by hash; each slice keeps its own smallest, and those are few.
    """
    slices = 64
    part = df.select(key, value).where(F.col(value).isNotNull()).distinct().withColumn("_s", F.pmod(F.xxhash64(value), F.lit(slices)))
    few = part.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_s").orderBy(value))).where(F.col("_rn") <= most)
    return few.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(value)), 1, most).alias("first"))
