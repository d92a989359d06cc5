"""Search: exact matches if there are any, else containing ones; unique captions; pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import SpecError
from ..functions.text import fold_caption, fold_search

MAX_PAGE = 100


def retrieve(rows: DataFrame, columns: list[str], query: str) -> DataFrame:
    """Rows of which a column equals the folded query; if there is none, rows of which one contains it.

    Whether there is any is one boolean over all rows, met by a broadcast of a single row.
    """
    q = fold_search(F.lit(query))
    folded = [fold_search(F.col(c).cast("string")) for c in columns]
    hit = lambda test: F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(test(f), F.lit(False)) for f in folded)), F.lit(False))
    flagged = rows.withColumn("exact", hit(lambda f: f == q)).withColumn("inside", hit(lambda f: F.contains(f, q)))
    any_exact = flagged.where("exact").limit(1).agg((F.count("*") > 0).alias("any_exact"))
    return flagged.crossJoin(F.broadcast(any_exact)).where("exact or (inside and not any_exact)").drop("inside", "any_exact")


def page(rows: DataFrame, order: list[str], offset: int = 0, limit: int = 25) -> DataFrame:
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise SpecError(f"a page has 1 to {MAX_PAGE} rows and starts at 0 or later")
    return rows.orderBy(*order).offset(offset).limit(limit)


def find(rows: DataFrame, id_col: str, caption_col: str, query: str) -> DataFrame:
    """(id, caption, tier, status): the best tier that hits: the id, the caption, a part of it.

    status is found for one hit and ambiguous for several: then all are candidates, and none is picked.
    """
    q = fold_caption(F.lit(query))
    cap = fold_caption(F.col(caption_col))
    tier = F.when(F.col(id_col).cast("string") == F.trim(F.lit(query)), 1).when(cap == q, 2).when(F.contains(F.lower(cap), F.lower(q)), 3)
    hits = rows.select(F.col(id_col).alias("id"), F.col(caption_col).alias("caption"), tier.alias("tier")).where("tier is not null")
    n = hits.groupBy("tier").agg(F.count("*").alias("n"))
    best = n.orderBy("tier").limit(1)
    return hits.join(F.broadcast(best), "tier").select("id", "caption", "tier", F.when(F.col("n") == 1, "found").otherwise("ambiguous").alias("status"))


def bounded(rows: DataFrame, json_col: str, most: int = 120_000) -> DataFrame:
    """(rows, bytes, summarised): whether the whole is over the bound, so that counts stand for rows."""
    size = F.sum(F.length(F.encode(json_col, "utf-8")))
    return rows.agg(F.count("*").alias("rows"), size.alias("bytes"), (F.coalesce(size, F.lit(0)) > most).alias("summarised"))
