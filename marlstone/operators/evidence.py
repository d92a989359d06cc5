"""Evidence: a ledger with stable numbers, and confidence from families of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import numbered
from .tables import stored

#: Confidence levels from strong to weak, and the family of each kind of source; a user's word has none.
LEVELS = ("CrossVerified", "Verified", "Observed", "Inferred", "Unknown")
FAMILIES = {
    "AssemblyMetadata": "binary", "IL": "binary", "CallGraph": "binary", "StringLiteral": "binary", "SQLLiteral": "binary", "DecompiledCode": "binary",
    "ExportSample": "sample", "MRTSample": "sample", "ExporterCode": "exchangeCode", "ImporterCode": "exchangeCode", "ConfigLiteral": "config", "Inference": "inference",
}


def rank(level: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), level)


def weakest(df: DataFrame, keys: list[str], level: str) -> DataFrame:
    """For each group its weakest level. A level that is none of LEVELS counts as Unknown."""
    r = F.when(rank(F.col(level)) > 0, rank(F.col(level))).otherwise(len(LEVELS))
    return df.groupBy(*keys).agg(F.element_at(F.array(*map(F.lit, LEVELS)), F.max(r).cast("int")).alias("confidence"))


def confidence(df: DataFrame, keys: list[str], source: str, families: dict[str, str] | None = None) -> DataFrame:
    """For each group: CrossVerified by two families, Verified by one, Inferred by inference alone, else Unknown."""
    families = FAMILIES if families is None else families
    pairs = [F.lit(x) for kv in families.items() for x in kv]
    fam = F.create_map(*pairs)[F.col(source)]
    real = F.count_distinct(F.when(fam != "inference", fam))
    guessed = F.coalesce(F.bool_or(fam == "inference"), F.lit(False))
    level = F.when(real >= 2, "CrossVerified").when(real == 1, "Verified").when(guessed, "Inferred").otherwise("Unknown")
    return df.groupBy(*keys).agg(level.alias("confidence"), real.alias("families"))


def ledger(entries: DataFrame, pos: str) -> DataFrame:
    """(evidence_id, source, detail, locator): distinct entries(prefix, source, detail, locator), numbered by first appearance in their prefix.

    Numbers come from range partitions over all prefixes, less the first of each: no prefix's facts meet in one task.
    """
    first = entries.groupBy("prefix", "source", "detail", "locator").agg(F.min(pos).alias("first"))
    placed = stored(numbered(first, ["prefix", "first", "source", "detail", "locator"], "at"), "ledger")
    starts = placed.groupBy("prefix").agg(F.min("at").alias("start"))
    n = (F.col("at") - F.col("start") + 1).cast("string")
    # a NULL prefix is one too
    placed = placed.join(starts.withColumnRenamed("prefix", "_prefix"), F.col("prefix").eqNullSafe(F.col("_prefix")))
    return placed.select(F.concat(F.lit("EVID-"), "prefix", F.lit("-"), F.when(F.length(n) < 6, F.lpad(n, 6, "0")).otherwise(n)).alias("evidence_id"), "prefix", "source", "detail", "locator")


def promotions(published: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Published levels that are stronger than their source's: none may be."""
    j = published.select(key, F.col("confidence").alias("published")).join(sources.select(key, F.col("confidence").alias("source")), key)
    return j.where(rank(F.col("published")) < rank(F.col("source")))


def gaps(rows: DataFrame) -> DataFrame:
    """(topic, reason, needed_for): gaps(topic, reason, needed_for, pos), one row a topic: the first reason, all uses sorted."""
    return rows.groupBy("topic").agg(F.min_by("reason", "pos").alias("reason"), F.array_sort(F.collect_set("needed_for")).alias("needed_for"))
