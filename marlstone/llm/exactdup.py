"""Exact dedup by a log-structured merge index over digests (DataFrame functions only).

* The input is dealt to MEMTABLES batches, each what some of the tasks read. A batch flushes a run: its digests,
  sorted, one row for each with the smallest identifier and the number of rows, and a membership filter.
* Compaction merges two runs. Each run's digests probe the other's filter: those that it rejects, mostly all, go
  to the merged run as they are; the others meet by digest, and the smallest identifier stays.
* Look-up: the digests of which the compacted level counts several rows are hits. Rows whose digest the
  hits' filter rejects are their own group and are not shuffled; the others are joined to the hits.
* Hits receive byte verification: the least and greatest of a digest's texts, compared as bytes, must be
  equal. A task sends one pair of texts a digest, not one text a row.
* Digests whose texts differ (collisions) are grouped anew by the text itself.

Filters are sized by the number of their keys; where they would exceed what may be broadcast, every digest counts
as a possible hit and is shuffled (see common).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Filter, flagged, free, may_hold, membership_filter, skew_join, stored

#: Batches that flush a run each.
MEMTABLES = 2


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


@dataclass
class Run:
    """rows(key, keep_id, n), sorted in each file, and the filter of the keys."""

    rows: DataFrame
    held: Filter

    def free(self) -> None:
        free(self.rows)
        self.held.free()


def flush(batch: DataFrame) -> Run:
    """The run of a batch(key, id)."""
    rows = stored(batch.groupBy("key").agg(F.min("id").alias("keep_id"), F.count("*").alias("n")).sortWithinPartitions("key"), "lsm-run")
    return Run(rows, membership_filter(rows, "key", "lsm-filter"))


def merge(a: Run, b: Run) -> Run:
    """One run of both, which are freed: digests that the other run's filter rejects pass without a shuffle."""
    both = flagged(a.rows, "key", b.held, "probed").unionByName(flagged(b.rows, "key", a.held, "probed"))
    met = both.where("probed").groupBy("key").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    rows = stored(both.where("not probed").drop("probed").unionByName(met).sortWithinPartitions("key"), "lsm-run")
    a.free()
    b.free()
    return Run(rows, membership_filter(rows, "key", "lsm-filter"))


def compact(runs: list[Run]) -> Run:
    """All runs as one, level by level."""
    while len(runs) > 1:
        runs = [merge(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32, memtables: int = MEMTABLES) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row for each input row.

    Texts are equal when equal after normalised(); the smallest id of a group stays. digest_bytes
    cuts the digest that the index uses (tests force collisions with it).

    Null text counts as empty. Rows that repeat an id are separate rows: each counts in group_size,
    and all rows with the smallest id stay, as nothing tells them apart. A null id is never the
    smallest unless the group has no other; then its rows stay. An empty table gives no rows.
    Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashed = rows.withColumn("norm", normalised(F.col("text"))).withColumn("sha", F.unhex(F.sha2("norm", 256)))
    key = F.substring("sha", 1, digest_bytes).alias("key")
    digests = stored(hashed.select("id", "sha", F.pmod(F.spark_partition_id(), F.lit(memtables)).alias("batch")), "lsm-digests").select("id", "sha", key, "batch")
    level = compact([flush(digests.where(F.col("batch") == b)) for b in range(memtables)])
    hits = stored(level.rows.where("n > 1"), "lsm-hits")
    level.free()
    held = membership_filter(hits, "key", "lsm-filter")
    verified = stored(
        may_hold(hashed.select(key, "norm"), "key", held)
        .groupBy("key")
        .agg(F.min("norm").alias("least"), F.max("norm").alias("most"))
        .select("key", (F.col("least") == F.col("most")).alias("same")),
        "lsm-verified",
    )
    collided = verified.where(~F.col("same")).select("key")
    clean = collided.isEmpty()
    seen = flagged(digests.drop("batch"), "key", held, "probed")
    if not clean:
        seen, texts = seen.join(collided, "key", "left_anti"), hashed.withColumn("key", key).join(collided, "key", "left_semi")
    met = seen.where("probed").drop("probed")
    # a filter lets some digests pass that are no hits
    alone = seen.where("not probed").drop("probed").unionByName(met.join(hits, "key", "left_anti"))
    alone = alone.select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    out = alone.unionByName(skew_join(met, hits, ["key"], "n").select("id", "sha", "keep_id", "n"))
    if not clean:
        # the texts of a collided digest form groups of their own, told apart by the full text
        apart = texts.groupBy("norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("n"))
        out = out.unionByName(texts.join(apart, "norm").select("id", "sha", "keep_id", "n"))
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
