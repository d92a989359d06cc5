"""Checks of what is proposed before it runs, and of the evidence that a verdict rests on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import acceptance_ids
from . import jsonschema
from .batch import GATES

#: The verdicts of an acceptance row.
VERDICTS = ("pass", "fail", "partial")
#: The form of both documents; what refers to something else is checked by joins.
PROPOSAL = {
    "type": "object",
    "required": ["proposal"],
    "properties": {
        "proposal": {
            "type": "object",
            "required": ["scope"],
            "properties": {
                "scope": {"type": "object", "required": ["allow"], "properties": {"allow": {"type": "array", "minItems": 1, "items": {"type": "string", "pattern": ":"}}}},
                "gates": {"type": ["array", "null"], "items": {"enum": list(GATES)}},
            },
        }
    },
}
EVIDENCE = {
    "type": "object",
    "required": ["evidence"],
    "properties": {
        "evidence": {
            "type": "object",
            "required": ["acceptance"],
            "properties": {
                "acceptance": {
                    "type": "array",
                    "minItems": 1,
                    "items": {"type": "object", "required": ["basis", "verdict"], "properties": {"basis": {"type": "string", "minLength": 1}, "verdict": {"enum": list(VERDICTS), "not": {"const": "fail"}}}},
                }
            },
        }
    },
}


def _texts(v: Column, path: str) -> Column:
    """The texts of an array, with their places; what is no text is left to the schema."""
    items = F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(F.transform(items, lambda x, i: F.struct(i.alias("at"), F.when(jsonschema.json_type(x) == "string", F.try_variant_get(x, "$", "string")).alias("text"))), lambda s: s["text"].isNotNull())


def proposal_findings(proposals: DataFrame, id_col: str, json_col: str, types: DataFrame, systems: DataFrame) -> DataFrame:
    """(id, place, rule, detail) of all that is wrong with proposals; one without findings may be handed on.

    types(objectType) are those of the contract; systems(system, allowed, indexed) are known systems, whether they may be
    changed, and whether their selectors are indexed: without an index no selector can be shown to exist. A scope's entry is
    type:selector, where the selector is * or starts with #.
    """
    form = jsonschema.findings(proposals, id_col, json_col, PROPOSAL)
    v = F.try_parse_json(json_col)
    entries = proposals.select(F.col(id_col), F.explode(_texts(v, "$.proposal.scope.allow")).alias("e")).where(F.contains(F.col("e.text"), F.lit(":")))
    place = F.concat(F.lit("$.proposal.scope.allow["), F.col("e.at").cast("string"), F.lit("]"))
    parts = entries.select(id_col, place.alias("place"), F.substring_index("e.text", ":", 1).alias("objectType"), F.expr("substring(e.text, instr(e.text, ':') + 1)").alias("selector"))
    unknown = parts.join(types.select("objectType").distinct(), "objectType", "left_anti").select(id_col, "place", F.lit("objectType").alias("rule"), F.col("objectType").alias("detail"))
    bad = parts.where(~F.col("selector").startswith("#") & (F.col("selector") != "*")).select(id_col, "place", F.lit("selector").alias("rule"), F.col("selector").alias("detail"))
    wanted = proposals.select(F.col(id_col), F.try_variant_get(v, "$.proposal.system", "string").alias("system")).where("system is not null and system <> ''")
    met = wanted.join(systems.select("system", "allowed", "indexed"), "system", "left")
    rules = F.array_compact(F.array(F.when(~F.coalesce("allowed", F.lit(False)), "systemNotAllowed"), F.when(~F.coalesce("indexed", F.lit(False)), "systemNotIndexed")))
    about = met.select(id_col, F.lit("$.proposal.system").alias("place"), F.explode(rules).alias("rule"), F.col("system").alias("detail"))
    return form.unionByName(unknown).unionByName(bad).unionByName(about)


def evidence_findings(results: DataFrame, id_col: str, json_col: str, tasks: DataFrame, text_col: str) -> DataFrame:
    """(id, place, rule, detail) of all that is wrong with the evidence of approved results.

    Every acceptance id in the task's text (tasks(id, text)) needs a row; a row needs a basis and a verdict, and none may say fail.
    """
    form = jsonschema.findings(results, id_col, json_col, EVIDENCE)
    v = F.try_parse_json(json_col)
    items = F.coalesce(F.try_variant_get(v, "$.evidence.acceptance", "array<variant>"), F.array().cast("array<variant>"))
    covered = results.select(F.col(id_col), F.explode(F.transform(items, lambda x: F.try_variant_get(x, "$.ac", "string"))).alias("ac")).distinct()
    # an acceptance block that isn't there is one finding and not one for each id
    there = results.where(F.try_variant_get(v, "$.evidence.acceptance", "array<variant>").isNotNull()).select(id_col)
    asked = tasks.select(F.col(id_col), F.explode(acceptance_ids(F.col(text_col))).alias("ac")).join(there, id_col, "left_semi")
    missing = asked.join(covered, [id_col, "ac"], "left_anti")
    return form.unionByName(missing.select(id_col, F.lit("$.evidence.acceptance").alias("place"), F.lit("uncovered").alias("rule"), F.col("ac").alias("detail")))
