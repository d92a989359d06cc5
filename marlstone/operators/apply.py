"""Applying change batches in phases: ids for what is created, placeholders for references, and their completion.

Phase 1 creates objects of the model, phase 2 rows of dynamic objects, phase 3 completes the references of both from
the ledger. Nothing depends on the order of a batch's text, and references may form cycles: what they point to has its
id before any of them is completed. All batches are applied at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batch import plan_levels, skipped
from .ranges import numbered
from .tables import free, stored

#: What stands in a reference's place until phase 3, and the type whose rows are created in phase 2.
PLACEHOLDER = -1
DYNAMIC = "dynamicObject"


def create(commands: DataFrame, references: DataFrame, refused: DataFrame, start: int = 1) -> DataFrame:
    """(batch_id, pos, tempId, phase, level, id, status): what becomes of each command, as a stored table.

    commands(batch_id, pos, objectType, tempId); references(batch_id, pos, field, tempId, structural); refused(batch_id, pos)
    are those that the runtime refuses. A structural reference must be met for the object to exist at all: its
    command is created after its target's (level), and has status dependency if that is not created, missing_target
    if no command of the batch has the tempId, and cycle if its structural references end in a cycle. Created objects have
    gapless ids from start on, by phase, batch, level and position; others have none.
    """
    key = ["batch_id", "pos"]
    known = commands.where("tempId is not null").select("batch_id", F.col("tempId").alias("_temp"), F.col("pos").alias("needs"))
    needed = references.where("structural").select(*key, F.col("tempId").alias("_temp"))
    met = stored(needed.join(known, ["batch_id", "_temp"], "left"), "apply-structure")
    edges = met.where("needs is not null").select("batch_id", F.col("pos").alias("node"), "needs").distinct()
    levels, cyclic = plan_levels(commands.select("batch_id", F.col("pos").alias("node")), edges)
    first = (
        refused.select(*key, F.lit(1).alias("why"))
        .unionByName(met.where("needs is null").select(*key, F.lit(2).alias("why")))
        .unionByName(cyclic.select("batch_id", F.col("node").alias("pos"), F.lit(3).alias("why")))
        .groupBy(*key)
        .agg(F.min("why").alias("why"))
    )
    first = stored(first, "apply-failed")
    # on a cycle, or below one, a command is told by the cycle and not by the one that it waits for
    after = skipped(edges, first.select("batch_id", F.col("pos").alias("node"))).select("batch_id", F.col("node").alias("pos"), F.lit(4).alias("why"))
    why = first.unionByName(after)
    status = F.element_at(F.array(*map(F.lit, ("created", "refused", "missing_target", "cycle", "dependency"))), F.coalesce("why", F.lit(0)) + 1)
    phase = F.when(F.col("objectType") == DYNAMIC, 2).otherwise(1)
    rows = commands.select(*key, "tempId", phase.alias("phase")).join(levels.select("batch_id", F.col("node").alias("pos"), "level"), key, "left").join(why, key, "left").withColumn("status", status).drop("why")
    rows = stored(rows, "apply-rows")
    made = numbered(rows.where("status = 'created'"), ["phase", "batch_id", "level", "pos"], "_at").withColumn("id", F.col("_at") + start).drop("_at")
    out = stored(made.unionByName(rows.where("status <> 'created'").withColumn("id", F.lit(None).cast("long"))).select(*key, "tempId", "phase", "level", "id", "status"), "apply-objects")
    free(met, first, rows)
    return out


def ledger(objects: DataFrame, commands: DataFrame, references: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """(batch_id, pos, field, tempId, placeholder, value, state, step, ordered): every deferred reference and its completion.

    objects is what create() gave. placeholder stands in the created row until the value is filled in; both are NULL where
    the row was not created. state: resolved; unresolved, where the target was not created; missing, where no command
    has the tempId; no_row, where the row itself was not created. Cycles of references are resolved like all others.
    step is the round of phase 3, from after(objectType, field, needs): a field is completed after those that it
    needs. Fields whose needs lead back to them come last, by name, and are marked by ordered = false.
    """
    key = ["batch_id", "pos"]
    target = objects.where("tempId is not null").select("batch_id", "tempId", F.col("id").alias("value"), F.lit(True).alias("there"))
    mine = objects.select(*key, F.col("id").alias("_own"))
    rows = references.where("not structural").select(*key, "field", "tempId").join(mine, key).join(target, ["batch_id", "tempId"], "left")
    created = F.col("_own").isNotNull()
    state = F.when(~created, "no_row").when(F.col("there").isNull(), "missing").when(F.col("value").isNull(), "unresolved").otherwise("resolved")
    rows = rows.select(*key, "field", "tempId", F.when(created, PLACEHOLDER).cast("long").alias("placeholder"), F.when(created, F.col("value")).alias("value"), state.alias("state"))
    if after is None:
        return rows.withColumn("step", F.lit(0)).withColumn("ordered", F.lit(True))
    steps, cyclic = plan_levels(
        after.select(F.col("objectType").alias("batch_id"), F.col("field").alias("node")).unionByName(after.select(F.col("objectType").alias("batch_id"), F.col("needs").alias("node"))).distinct(),
        after.select(F.col("objectType").alias("batch_id"), F.col("field").alias("node"), "needs"),
    )
    # a row for each field of a type, as many as the contract has
    last = steps.groupBy("batch_id").agg((F.max("level") + 1).alias("last"))
    back = cyclic.join(last, "batch_id", "left").select("batch_id", "node", F.coalesce("last", F.lit(0)).alias("level"), F.lit(False).alias("ordered"))
    order = steps.withColumn("ordered", F.lit(True)).unionByName(back).select(F.col("batch_id").alias("objectType"), F.col("node").alias("field"), F.col("level").alias("step"), "ordered")
    typed = rows.join(commands.select(*key, "objectType"), key)
    return typed.join(order, ["objectType", "field"], "left").drop("objectType").withColumn("step", F.coalesce("step", F.lit(0))).withColumn("ordered", F.coalesce("ordered", F.lit(True)))


def filled(rows: DataFrame, completed: DataFrame) -> DataFrame:
    """rows(batch_id, pos, field, reference) of what phases 1 and 2 wrote, with placeholders replaced by the ledger's values, where it has them."""
    values = completed.where("state = 'resolved'").select("batch_id", "pos", "field", "value")
    return rows.join(values, ["batch_id", "pos", "field"], "left").withColumn("reference", F.when(F.col("reference") == PLACEHOLDER, F.coalesce("value", "reference")).otherwise(F.col("reference"))).drop("value")
