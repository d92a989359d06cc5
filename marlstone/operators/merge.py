"""Merging sources: full outer merges with provenance, last known values, assignment, presence, staleness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_merge(a: DataFrame, b: DataFrame, key: str, prefer: list[str] = (), apart: list[str] = ()) -> DataFrame:
    """A full outer join on key. Columns in prefer take a's value, then b's; those in apart stay apart as col_a, col_b.

    source says which sides have the key: both, a or b. NULL keys meet nothing and stay rows of their side.
    """
    l, r = a.select(*(F.col(c).alias(f"a_{c}") for c in a.columns)), b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
    j = l.withColumn("in_a", F.lit(True)).join(r.withColumn("in_b", F.lit(True)), F.col(f"a_{key}") == F.col(f"b_{key}"), "full")
    source = F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "a").otherwise("b")
    cols = [F.coalesce(f"a_{key}", f"b_{key}").alias(key)]
    cols += [F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in prefer]
    cols += [F.col(f"{s}_{c}").alias(f"{c}_{s}") for c in apart for s in "ab"]
    return j.select(*cols, source.alias("source"))


def last_known(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """For each key the last value of each column that is not NULL, by order. One pass with partial aggregation."""
    return rows.groupBy(key).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def assign(rows: DataFrame, owner_cols: list[str], owners: DataFrame, id_col: str, system_col: str) -> DataFrame:
    """rows with system: that of the first owner column, in order, whose owner has one. Rows stay rows: none is lost or doubled.

    owners(id, system) must have one row an id.
    """
    out = rows
    for i, c in enumerate(owner_cols):
        o = owners.select(F.col(id_col).alias(f"_o{i}"), F.col(system_col).alias(f"_s{i}"))
        out = out.join(o, F.col(c) == F.col(f"_o{i}"), "left").drop(f"_o{i}")
    found = F.coalesce(*(F.col(f"_s{i}") for i in range(len(owner_cols))))
    return out.withColumn("system", found).drop(*(f"_s{i}" for i in range(len(owner_cols))))


def presence(concepts: DataFrame, key: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """A row for each concept with a flag for each source that has it. Keys compare without case."""
    out = concepts.select(F.col(key), F.lower(key).alias("_k"))
    for name, (df, col) in sources.items():
        there = df.select(F.lower(F.col(col)).alias("_k")).where("_k is not null").distinct().withColumn(f"in_{name}", F.lit(True))
        out = out.join(there, "_k", "left").withColumn(f"in_{name}", F.coalesce(f"in_{name}", F.lit(False)))
    return out.drop("_k")


def absent(rows: DataFrame, col: str, known: DataFrame, known_col: str, most: int | None = None) -> DataFrame:
    """Distinct values of rows that known lacks, without case, sorted; most bounds the report, not the search."""
    k = known.select(F.lower(F.col(known_col)).alias("_k")).distinct()
    out = rows.select(F.col(col)).distinct().withColumn("_k", F.lower(col)).join(k, "_k", "left_anti").drop("_k").orderBy(col)
    return out.limit(most) if most is not None else out


def staleness(recorded: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state): changed, gone or new between two hash lists; equal ones are left out."""
    j = recorded.select(F.col(key), F.col(digest).alias("old")).join(current.select(F.col(key), F.col(digest).alias("now")), key, "full")
    state = F.when(F.col("now").isNull(), "gone").when(F.col("old").isNull(), "new").when(F.col("now") != F.col("old"), "changed")
    return j.select(key, state.alias("state")).where("state is not null")


def append_if_new(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """rows, and those of more whose keys are not among them (NULL equals NULL)."""
    known = rows.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = c if same is None else same & c
    return rows.unionByName(more.join(known, same, "left_anti"), allowMissingColumns=True)


def patched(rows: DataFrame, patches: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with JSON patches(key, patch) applied: an absent name changes nothing, an explicit null sets NULL."""
    p = patches.select(F.col(key), F.try_parse_json("patch").alias("_p"))
    j = rows.join(p, key, "left")
    for c in columns:
        kind = rows.schema[c].dataType.simpleString()
        there = F.expr(f"variant_get(_p, '$.{c}')")
        new = F.expr(f"try_variant_get(_p, '$.{c}', '{kind}')")
        j = j.withColumn(c, F.when(there.isNull(), F.col(c)).otherwise(F.when(F.is_variant_null(there), None).otherwise(new)))
    return j.drop("_p")


def upsert_plan(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """(key, action): create where nothing has the key, update where one row has, ambiguous where several do. Rows that are not wanted stay."""
    n = existing.groupBy(key).agg(F.count("*").alias("n"))
    action = F.when(F.col("n").isNull(), "create").when(F.col("n") == 1, "update").otherwise("ambiguous")
    return wanted.select(key).distinct().join(n, key, "left").select(key, action.alias("action"))
