"""Catalogues over many rows: who uses what, where literals stand, what two sides say about the same things."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .match import ranked_first


def inverted(uses: DataFrame, caller: str, callee: str, most: int | None = None) -> DataFrame:
    """(callee, callers, n): for each callee its distinct callers, sorted, and how many they are.

    Callers are made distinct before they are gathered. most bounds the list, the smallest first, not the number: a callee
    that a third of all rows use is then still a short row. NULL callees are none, NULL callers are left out.
    """
    pairs = uses.select(F.col(callee).alias("callee"), F.col(caller).alias("caller")).where("callee is not null and caller is not null").distinct()
    n = pairs.groupBy("callee").agg(F.count("*").alias("n"))
    first = ranked_first(pairs, "callee", "caller", most).withColumnRenamed("first", "callers") if most else pairs.groupBy("callee").agg(F.array_sort(F.collect_list("caller")).alias("callers"))
    return n.join(first, "callee").select("callee", "callers", "n")


def argmax(rows: DataFrame, keys: list[str], value: str, by: list[str], name: str) -> DataFrame:
    """(keys, name): the value of each key's greatest row, by by. Rows whose by is NULL in all columns don't count."""
    there = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in by))
    return rows.groupBy(*keys).agg(F.max_by(value, F.when(there, F.struct(*by))).alias(name))


def owned(rows: DataFrame, owner: str, ours: str, name: str, dull: str) -> DataFrame:
    """The rows whose owner matches ours, without names that match dull (accessors and other machinery). NULL owners are not ours."""
    return rows.where(F.col(owner).rlike(ours) & ~F.coalesce(F.col(name).rlike(dull), F.lit(False)))


def tagged(rows: DataFrame, id_col: str, name: str, terms: list[str]) -> DataFrame:
    """(term, n): how many ids have a name that holds the term, whatever its case. One pass however many terms there are."""
    lowered = F.lower(name)
    hits = F.array_compact(F.array(*(F.when(F.contains(lowered, F.lit(x.lower())), x) for x in terms)))
    return rows.select(F.col(id_col).alias("_id"), F.explode(hits).alias("term")).distinct().groupBy("term").agg(F.count("_id").alias("n"))


def sites(rows: DataFrame, literal: str, site: str, shortest: int = 1, longest: int = 8000, most: int = 8) -> DataFrame:
    """(literal, sites, n): where each literal of a fit length stands: its smallest sites, most at most, and the number of all."""
    fit = rows.where(F.length(literal).between(shortest, longest)).select(F.col(literal).alias("literal"), F.col(site).alias("site"))
    # the smallest are chosen before they are gathered, so a frequent literal stays a few values
    return ranked_first(fit, "literal", "site", most).join(fit.groupBy("literal").agg(F.count("*").alias("n")), "literal").select("literal", F.col("first").alias("sites"), "n")


def vocabulary(a: DataFrame, b: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(left, right, n, share, agreed): how the values of one side go with those of the other, over rows that share a key.

    share is n's part of the rows with that left value; a pair is agreed if it is the only one of both its values. NULL
    values say nothing.
    """
    met = a.select(F.col(key), F.col(left).alias("left")).join(b.select(F.col(key), F.col(right).alias("right")), key).where("left is not null and right is not null")
    pairs = met.groupBy("left", "right").agg(F.count("*").alias("n"))
    of_left = pairs.groupBy("left").agg(F.sum("n").alias("all"), F.count("*").alias("rights"))
    of_right = pairs.groupBy("right").agg(F.count("*").alias("lefts"))
    j = pairs.join(of_left, "left").join(of_right, "right")
    return j.select("left", "right", "n", (F.col("n") / F.col("all")).alias("share"), ((F.col("rights") == 1) & (F.col("lefts") == 1)).alias("agreed"))


def reconciled(systems: DataFrame, system: str, sides: dict[str, tuple[DataFrame, str]], comparable: Column | None = None) -> DataFrame:
    """(system, a count for each side, agrees): rows of each side by system; agrees is NULL where sides can't be compared.

    Systems that a side doesn't know have 0 there; rows of unknown systems are no system's.
    """
    j = systems
    for name, (rows, key) in sides.items():
        j = j.join(rows.groupBy(F.col(key).alias(f"_{name}")).agg(F.count("*").alias(name)), F.col(system) == F.col(f"_{name}"), "left")
    counts = [F.coalesce(name, F.lit(0)) for name in sides]
    same = reduce(lambda a, b: a & b, (c == counts[0] for c in counts[1:]), F.lit(True))
    return j.select(F.col(system).alias("system"), *(c.alias(n) for c, n in zip(counts, sides, strict=True)), (same if comparable is None else F.when(comparable, same)).alias("agrees"))


def copies(rows: DataFrame, text: str, id_col: str) -> DataFrame:
    """(sha256, first_id, n) of each text: NULL counts as empty. Equal digests are equal texts for all that SHA-256 can tell."""
    return rows.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha256")).agg(F.min(id_col).alias("first_id"), F.count("*").alias("n"))


def observed_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, rows): every column of the tables with the number of its values that are not NULL: one pass a table."""
    each = []
    for name, df in tables.items():
        counts = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns))
        each.append(counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "rows").select(F.lit(name).alias("table"), "column", "rows"))
    return reduce(DataFrame.unionByName, each)


def table_catalogue(declared: DataFrame, used: DataFrame) -> DataFrame:
    """(table, places, declared, confidence): tables that statements name, with the places of these, and tables that are declared.

    declared(table); used(table, place), a row for each mention. Names compare exactly. A table of one side alone stays: without
    places, or not declared. What both sides know is CrossVerified, all else Verified.
    """
    a = declared.select("table").where("table is not null").distinct().withColumn("_declared", F.lit(True))
    pairs = used.select("table", "place").where("table is not null").distinct()
    b = pairs.groupBy("table").agg(F.array_sort(F.collect_list("place")).alias("places"))  # places are made distinct before
    j = a.join(b, "table", "full").withColumn("declared", F.coalesce("_declared", F.lit(False)))
    both = F.col("declared") & F.col("places").isNotNull()
    none = F.array().cast(b.schema["places"].dataType)
    return j.select("table", F.coalesce("places", none).alias("places"), "declared", F.when(both, "CrossVerified").otherwise("Verified").alias("confidence"))
