"""Build gates: each gives one row (gate, offenders, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a whole pack, of a file, and of the part that every scope shares.
TOTAL, FILE, CONTRACT = 512_000, 153_600, 122_880


def gate(name: str, offenders: DataFrame, most: int = 20, label: str | None = None) -> DataFrame:
    """passed without offenders; up to most of the smallest labels are shown, all are counted."""
    n = offenders.agg(F.count("*").alias("offenders"))
    if label:
        few = offenders.orderBy(label).limit(most).agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col(label).cast("string")))).alias("shown"))
        n = n.crossJoin(F.broadcast(few))
    return n.select(F.lit(name).alias("gate"), *n.columns, (F.col("offenders") == 0).alias("passed"))


def all_passed(gates: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, gates)


def budget(files: DataFrame, size: str, exempt: Column, contract: Column, total: int = TOTAL, each: int = FILE, shared: int = CONTRACT) -> DataFrame:
    """Sums and verdicts of a pack's budget; exempt files count for the cap of a file only."""
    counted = F.coalesce(F.sum(F.when(~exempt, F.col(size))), F.lit(0))
    common = F.coalesce(F.sum(F.when(~exempt & contract, F.col(size))), F.lit(0))
    out = files.agg(counted.alias("total_bytes"), common.alias("contract_bytes"), F.coalesce(F.max(size), F.lit(0)).alias("largest"), F.count("*").alias("files"))
    return out.withColumn("passed", (F.col("total_bytes") <= total) & (F.col("contract_bytes") <= shared) & (F.col("largest") <= each))


def group_membership(members: DataFrame, universe: DataFrame, group: str, item: str) -> DataFrame:
    """(item, problem): items in several groups, in a group but unknown, known but in no group."""
    n = members.groupBy(item).agg(F.count_distinct(group).alias("n"))
    twice = n.where("n > 1").select(item, F.lit("duplicated").alias("problem"))
    drift = members.select(item).distinct().join(universe.select(item).distinct(), item, "left_anti").withColumn("problem", F.lit("drift"))
    bare = universe.select(item).distinct().join(members.select(item).distinct(), item, "left_anti").withColumn("problem", F.lit("uncovered"))
    return twice.unionByName(drift).unionByName(bare)


def missing_text(files: DataFrame, text: str, wanted: str) -> DataFrame:
    return files.where(~F.contains(F.coalesce(F.col(text), F.lit("")), F.lit(wanted)))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of a unique constraint that several rows share, with their count; NULLs never break it."""
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return rows.where(whole).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def same_identity(reported: Column, expected: Column) -> Column:
    """match, mismatch or unreported: what is not reported is no match."""
    return F.when(reported.isNull() | (reported == ""), "unreported").when(F.lower(reported) == F.lower(expected), "match").otherwise("mismatch")
