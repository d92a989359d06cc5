"""Which systems a row of the model belongs to: ordered rules as one relation of owners, joined once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hierarchy import owners
from .tables import free, stored

#: The collections of each rule, and the columns that name an owner there.
BY_ENTITY = ("fields", "views", "businessRules", "workflows")
BY_ENDS = ("relationDefs",)
BY_TARGET = ("code", "commands", "webServices")
COLUMNS = ("systemId", "entityId", "_ownerId", "sourceEntity", "targetEntity", "targetObjectId", "targetId")


def _candidates(columns: set[str]) -> Column:
    """(rule, kind, key) of all owners that a row names, in order of the rules. A row's own system is its only one, known or not."""
    col = lambda c: F.col(c).cast("string") if c in columns else F.lit(None).cast("string")
    one = lambda rule, kind, key: F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), key.alias("key"))
    none = F.array().cast("array<struct<rule:string,kind:string,key:string>>")
    is_ = F.col("collection").isin
    ends = F.array(*(one("ends", "entity", col(c)) for c in ("sourceEntity", "targetEntity", "entityId", "_ownerId")))
    by_rule = (
        F.when(col("systemId").isNotNull(), F.array(one("own", "system", col("systemId"))))
        .when(is_("entities"), F.array(one("entity", "entity", F.col("id").cast("string"))))
        .when(is_(*BY_ENTITY), F.array(one("owner", "entity", F.coalesce(F.nullif(col("entityId"), F.lit("")), col("_ownerId")))))
        .when(is_(*BY_ENDS), ends)
        .when(is_("navigation"), F.array(one("folder", "folder", F.col("id").cast("string"))))
        .when(is_(*BY_TARGET), F.array(one("target", "entity", F.coalesce(F.nullif(col("targetObjectId"), F.lit("")), F.nullif(col("targetId"), F.lit("")), col("_ownerId")))))
    )
    return F.coalesce(F.filter(by_rule, lambda c: c["key"].isNotNull()), none)


def assigned(rows: DataFrame, systems: DataFrame, entities: DataFrame, folders: DataFrame) -> DataFrame:
    """rows with rule, systems and state. Rows stay rows: none is lost, doubled or assigned by its name.

    rows(collection, id, ...) may have any of COLUMNS. systems(id, rootFolderId), entities(id, systemId), folders(id, parentId).
    If there is one system, all is its own (rule single). Else a row's own systemId decides, also if no system has it; else an
    entity is its system's; fields, views, rules and workflows are their entity's; a definition of a relation is that of any of
    four owners; a folder is the system's whose root folder is its topmost above; code, commands and services are their
    target's. systems is the sorted list: empty if no owner is known (state unassigned), several if the ends of a relation
    belong to several (state shared), else one (state assigned). An entity or root folder with several systems counts for each.
    """
    known = systems.where("id is not null").select(F.col("id").cast("string").alias("system")).distinct()
    few = known.limit(2).collect()
    none = F.array().cast("array<string>")
    if len(few) == 1:
        return rows.withColumn("rule", F.lit("single")).withColumn("systems", F.array(F.lit(few[0].system))).withColumn("state", F.lit("assigned"))
    of_entity = entities.where("id is not null").select(F.lit("entity").alias("kind"), F.col("id").cast("string").alias("key"), F.col("systemId").cast("string").alias("system")).join(known, "system", "left_semi")
    nodes = folders.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(F.min(F.col("parentId").cast("string")).alias("parentId"))
    roots = systems.where("rootFolderId is not null").groupBy(F.col("rootFolderId").cast("string").alias("id")).agg(F.array_sort(F.collect_set(F.col("id").cast("string"))).alias("owner"))
    above, _ = owners(nodes, roots, "id", "parentId")
    of_folder = above.select(F.lit("folder").alias("kind"), F.col("id").alias("key"), F.explode("owner").alias("system"))
    owner = known.select(F.lit("system").alias("kind"), F.col("system").alias("key"), "system").unionByName(of_entity).unionByName(of_folder)
    owner = owner.groupBy("kind", "key").agg(F.collect_set("system").alias("found"))  # one row a key: no row is doubled

    kept = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "assign-rows")
    asked = kept.select("_row", F.explode(_candidates(set(rows.columns))).alias("c")).select("_row", "c.*")
    met = asked.join(owner, ["kind", "key"], "left").groupBy("_row").agg(F.min("rule").alias("rule"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("systems"))
    out = kept.join(met, "_row", "left").drop("_row").withColumn("systems", F.coalesce("systems", none))
    n = F.size("systems")
    out = stored(out.withColumn("rule", F.when(n > 0, F.col("rule"))).withColumn("state", F.when(n == 0, "unassigned").when(n == 1, "assigned").otherwise("shared")), "assigned")
    free(kept)
    return out


def coverage(assigned_rows: DataFrame) -> DataFrame:
    """(collection, artifact_rows, assigned_rows, shared_rows): what of each collection found a system."""
    return assigned_rows.groupBy("collection").agg(F.count("*").alias("artifact_rows"), F.count_if(F.col("state") != "unassigned").alias("assigned_rows"), F.count_if(F.col("state") == "shared").alias("shared_rows"))
