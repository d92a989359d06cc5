"""Change batches: lint rules, gates and plans over rows of commands.

A command row: pos, commandId, operation, objectType, tempId, target (struct of selector, tempId), parent (the
same), properties (JSON text). Every check is a DataFrame of findings(gate, pos, message, severity); a gate without
findings passed. Rows of one batch share batch_id, so many batches are checked at once.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored

#: Operations, keys that only a runtime may set, the profile that batches must name, the gates.
OPERATIONS = ("create", "update", "delete")
RUNTIME_KEYS = ("id", "rowId", "sourceId", "runtimeId", "dependencyKey")
PROFILE = 15
GATES = ("lint", "selectors", "unknowns", "scope", "order")


def _found(df: DataFrame, gate: str, message: Column | str, severity: str = "error") -> DataFrame:
    m = F.lit(message) if isinstance(message, str) else message
    return df.select("batch_id", F.lit(gate).alias("gate"), F.col("pos").cast("long").alias("pos"), m.alias("message"), F.lit(severity).alias("severity"))


def _after_first(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value was used before in their batch."""
    first = df.where(F.col(column).isNotNull()).groupBy("batch_id", column).agg(F.min("pos").alias("_first"))
    return df.join(first, ["batch_id", column]).where("pos > _first").drop("_first")


def lint(commands: DataFrame, object_types: list[str]) -> DataFrame:
    """Findings of single commands: names, ids, references and forbidden keys."""
    c = commands
    keys = F.json_object_keys("properties")
    forbidden = F.array_intersect(keys, F.array(*map(F.lit, RUNTIME_KEYS)))
    declared = c.where(F.col("operation") == "create").where("tempId is not null").select("batch_id", F.col("tempId").alias("known")).distinct()
    refs = c.select("batch_id", "pos", F.explode(F.array_compact(F.array("target.tempId", "parent.tempId"))).alias("known"))
    selector = F.coalesce("target.selector", "parent.selector")
    rules = [
        _found(c.where("commandId is null or commandId = ''"), "lint", "commandId is missing"),
        _found(_after_first(c, "commandId"), "lint", F.concat(F.lit("commandId is used twice: "), "commandId")),
        _found(c.where(F.col("operation").isNull() | ~F.col("operation").isin(*OPERATIONS)), "lint", "unknown operation"),
        _found(c.where("objectType is null"), "lint", "objectType is missing"),
        _found(c.where(~F.col("objectType").isin(*object_types)), "lint", F.concat(F.lit("unknown objectType: "), "objectType")),
        _found(c.where("tempId is not null and operation <> 'create'"), "lint", "tempId is for create only"),
        _found(_after_first(c, "tempId"), "lint", F.concat(F.lit("tempId is used twice: "), "tempId")),
        _found(refs.join(declared, ["batch_id", "known"], "left_anti"), "lint", F.concat(F.lit("tempId is never created: "), "known")),
        _found(c.where(F.size(forbidden) > 0), "lint", F.concat(F.lit("runtime key: "), F.array_join(F.array_sort(forbidden), ","))),
        _found(c.where(selector.isNotNull() & ~selector.rlike(r"^#\S")), "lint", F.concat(F.lit("not a selector: "), selector)),
        _found(c.where("operation = 'create' and parent is null"), "lint", "create without a parent", "warning"),
        _found(c.where(F.col("properties").isNotNull() & F.try_parse_json("properties").isNull()), "lint", "properties are no JSON"),
    ]
    return reduce(DataFrame.unionByName, rules)


def header_findings(batches: DataFrame) -> DataFrame:
    """Findings of batch headers(batch_id, profileVersion, errorPolicy, n_changes)."""
    h = batches.withColumn("pos", F.lit(None).cast("long"))
    return reduce(
        DataFrame.unionByName,
        [
            _found(h.where(~F.col("profileVersion").eqNullSafe(F.lit(PROFILE))), "lint", f"profileVersion must be {PROFILE}"),
            _found(h.where(F.col("errorPolicy").isNotNull() & ~F.col("errorPolicy").isin("Stop", "ContinueIndependent")), "lint", "unknown errorPolicy"),
            _found(h.where("coalesce(n_changes, 0) = 0"), "lint", "no changes"),
        ],
    )


def selector_gate(commands: DataFrame, index: DataFrame) -> DataFrame:
    """Selectors that the index(selector) lacks, those inside relation paths too."""
    direct = commands.select("batch_id", "pos", F.explode(F.array_compact(F.array("target.selector", "parent.selector"))).alias("selector"))
    inner = commands.select("batch_id", "pos", F.explode(F.regexp_extract_all("properties", F.lit(r'"(#[^"\\]+)"'), 1)).alias("selector"))
    known = index.select("selector").distinct()
    gone = direct.unionByName(inner).distinct().join(known, "selector", "left_anti")
    return _found(gone, "selectors", F.concat(F.lit("unknown selector: "), "selector"))


def unknown_gate(commands: DataFrame, contract: DataFrame) -> DataFrame:
    """Properties that contract(objectType, property, create, update) doesn't allow for the operation."""
    used = commands.select("batch_id", "pos", "objectType", "operation", F.explode(F.json_object_keys("properties")).alias("property"))
    create = contract.where("create").select("objectType", "property", F.lit("create").alias("operation"))
    allowed = create.unionByName(contract.where("update").select("objectType", "property", F.lit("update").alias("operation")))
    return _found(used.join(allowed, ["objectType", "property", "operation"], "left_anti"), "unknowns", F.concat(F.lit("not authorable: "), "property"))


def scope_gate(commands: DataFrame, allow: DataFrame, deny: DataFrame) -> DataFrame:
    """Commands outside allow(batch_id, entry) or inside deny(batch_id, entry); an entry is type:selector or type:*."""
    name = F.coalesce("target.selector", F.get_json_object("properties", "$.name"), "tempId", F.lit("?"))
    c = commands.select("batch_id", "pos", F.concat("objectType", F.lit(":"), name).alias("entry"), F.concat("objectType", F.lit(":*")).alias("wild"))

    def hit(entries: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        e = entries.select("batch_id", "entry").distinct()
        return rows.join(e, ["batch_id", "entry"], how)

    outside = hit(allow, "left_anti", c)
    outside = outside.join(allow.select("batch_id", F.col("entry").alias("wild")).distinct(), ["batch_id", "wild"], "left_anti")
    inside = hit(deny, "left_semi", c).unionByName(c.join(deny.select("batch_id", F.col("entry").alias("wild")).distinct(), ["batch_id", "wild"], "left_semi")).distinct()
    return _found(outside, "scope", F.concat(F.lit("not allowed: "), "entry")).unionByName(_found(inside, "scope", F.concat(F.lit("denied: "), "entry")))


def order_gate(commands: DataFrame, structure: DataFrame) -> DataFrame:
    """Commands whose structure(objectType, rank) is below the one before, and parents that are created later.

    Types without a rank are skipped: the one before is the last ranked command. A batch's commands are read in order
    by one task; batches are documents of bounded size.
    """
    c = commands.join(structure, "objectType").withColumn("before", F.lag("rank").over(Window.partitionBy("batch_id").orderBy("pos")))
    early = c.where("rank < before")
    made = commands.where("operation = 'create' and tempId is not null").groupBy("batch_id", F.col("tempId").alias("known")).agg(F.min("pos").alias("made"))
    late = commands.select("batch_id", "pos", F.col("parent.tempId").alias("known")).join(made, ["batch_id", "known"]).where("made >= pos")
    return _found(early, "order", "stands after its dependants").unionByName(_found(late, "order", F.concat(F.lit("parent is created later: "), "known")))


def summary(batches: DataFrame, findings: DataFrame) -> DataFrame:
    """(batch_id, gate, errors, warnings, passed) for every gate of every batch."""
    gates = batches.select("batch_id", F.explode(F.array(*map(F.lit, GATES))).alias("gate"))
    n = findings.groupBy("batch_id", "gate").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    j = gates.join(n, ["batch_id", "gate"], "left")
    return j.select("batch_id", "gate", F.coalesce("errors", F.lit(0)).cast("long").alias("errors"), F.coalesce("warnings", F.lit(0)).cast("long").alias("warnings"), (F.coalesce("errors", F.lit(0)) == 0).alias("passed"))


def plan_levels(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((batch_id, node, level), cyclic nodes): level 0 needs nothing, others come after all that they need.

    edges(batch_id, node, needs). Kahn's rounds, for all batches at once.
    """
    left = stored(nodes.select("batch_id", "node"), "plan")
    open_edges = stored(edges.select("batch_id", "node", "needs").distinct().join(nodes.select("batch_id", F.col("node").alias("needs")), ["batch_id", "needs"], "left_semi"), "plan")
    done = None
    for level in count():
        ready = stored(left.join(open_edges.select("batch_id", "node").distinct(), ["batch_id", "node"], "left_anti").withColumn("level", F.lit(level)), "plan")
        if ready.isEmpty():
            break
        done = ready if done is None else done.unionByName(ready)
        left = stored(left.join(ready, ["batch_id", "node"], "left_anti"), "plan")
        open_edges = stored(open_edges.join(ready.select("batch_id", F.col("node").alias("needs")), ["batch_id", "needs"], "left_anti"), "plan")
    if done is None:
        done = left.withColumn("level", F.lit(0)).limit(0)
    return done, left


def skipped(edges: DataFrame, failed: DataFrame) -> DataFrame:
    """(batch_id, node) that depend on a failed node, directly or not; independent nodes go on."""
    bad = front = stored(failed.select("batch_id", "node").distinct(), "skip")
    while True:
        nxt = edges.join(front.select("batch_id", F.col("node").alias("needs")), ["batch_id", "needs"], "left_semi").select("batch_id", "node").distinct()
        front = stored(nxt.join(bad, ["batch_id", "node"], "left_anti"), "skip")
        if front.isEmpty():
            break
        bad = bad.unionByName(front)
    return bad.join(failed.select("batch_id", "node"), ["batch_id", "node"], "left_anti")
