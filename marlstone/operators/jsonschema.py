"""JSON schemas as one native expression over VARIANT: every finding of a document with its place, in one pass.

A schema is compiled, not interpreted: its keywords become column expressions, arrays are checked by nested transforms, and
a document's findings come out as one array. References are resolved while compiling, so a schema that holds itself is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import SpecError
from .jsonwalk import json_type

#: Keywords that say nothing about a document, those that are checked, and the names of types.
ANNOTATIONS = ("$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples")
CHECKED = (
    "$ref", "type", "const", "enum", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "minProperties", "maxProperties", "minLength", "maxLength", "pattern",
    "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "allOf", "anyOf", "not",
)
TYPES = ("null", "object", "array", "boolean", "number", "integer", "string")
FINDING = "array<struct<place:string,rule:string,detail:string>>"
_NUMBER = "decimal(38,9)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _none() -> Column:
    return F.array().cast(FINDING)


def _found(bad: Column, place: Column, rule: str, detail: str | Column) -> Column:
    """One finding where bad is true; NULL is not."""
    made = F.struct(place.alias("place"), F.lit(rule).alias("rule"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))
    return F.when(bad, F.array(made).cast(FINDING)).otherwise(_none())


def _all(parts: list[Column]) -> Column:
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()


def _member(v: Column, name: str) -> Column:
    """A property as VARIANT: SQL NULL if it isn't there."""
    if "'" in name or "\\" in name:
        raise SpecError(f"schema: a property's name may not hold a quote or a backslash: {name}")
    return F.try_variant_get(v, f"$['{name}']", "variant")


def _is_a(v: Column, kind: Column, name: str) -> Column:
    if name == "integer":
        return (kind == "number") & _let(F.try_variant_get(v, "$", "double"), lambda x: (x == F.floor(x)) & x.isNotNull())
    return kind == name


def _same(v: Column, kind: Column, value: Any) -> Column:
    """Whether the value is that scalar, with JSON's own idea of equality: 1 is 1.0, and not true or "1"."""
    if value is None:
        return kind == "null"
    if isinstance(value, bool):
        return (kind == "boolean") & F.try_variant_get(v, "$", "boolean").eqNullSafe(F.lit(value))
    if isinstance(value, (int, float)):
        return (kind == "number") & F.try_variant_get(v, "$", _NUMBER).eqNullSafe(F.lit(Decimal(str(value))).cast(_NUMBER))
    if isinstance(value, str):
        return (kind == "string") & F.try_variant_get(v, "$", "string").eqNullSafe(F.lit(value))
    raise SpecError("schema: const and enum hold scalars only")


class _Compiler:
    def __init__(self, schema: dict) -> None:
        self.root = schema

    def resolved(self, schema: Any, seen: tuple[str, ...]) -> tuple[Any, tuple[str, ...]]:
        while isinstance(schema, dict) and "$ref" in schema:
            ref = schema["$ref"]
            if ref in seen:
                raise SpecError(f"schema: {ref} holds itself")
            if not re.fullmatch(r"#(/[^/]+)*", ref):
                raise SpecError(f"schema: {ref} is no place in the schema")
            rest = {k: v for k, v in schema.items() if k not in ("$ref", *ANNOTATIONS)}
            seen = (*seen, ref)
            at: Any = self.root
            for step in ref.split("/")[1:]:
                step = step.replace("~1", "/").replace("~0", "~")
                if not isinstance(at, dict) or step not in at:
                    raise SpecError(f"schema: {ref} leads nowhere")
                at = at[step]
            schema = {"allOf": [at, rest]} if rest else at
        return schema, seen

    def findings(self, schema: Any, v: Column, place: Column, seen: tuple[str, ...] = ()) -> Column:
        """The findings of a value that is there."""
        schema, seen = self.resolved(schema, seen)
        if schema is True:
            return _none()
        if schema is False:
            return _found(F.lit(True), place, "false", "nothing is allowed here")
        if not isinstance(schema, dict):
            raise SpecError("schema: a schema is an object or a boolean")
        if unknown := [k for k in schema if k not in (*ANNOTATIONS, *CHECKED)]:
            raise SpecError(f"schema: unknown keyword {unknown[0]}")
        return _let(json_type(v), lambda kind: self._checked(schema, v, kind, place, seen))

    def _checked(self, s: dict, v: Column, kind: Column, place: Column, seen: tuple[str, ...]) -> Column:
        out: list[Column] = []
        if "type" in s:
            names = [s["type"]] if isinstance(s["type"], str) else list(s["type"])
            if bad := [n for n in names if n not in TYPES]:
                raise SpecError(f"schema: unknown type {bad[0]}")
            out.append(_found(~reduce(lambda a, b: a | b, (_is_a(v, kind, n) for n in names)), place, "type", F.concat(F.lit(f"{' or '.join(names)} is asked for, it is "), kind)))
        for key, values in (("const", [s["const"]] if "const" in s else None), ("enum", s.get("enum"))):
            if values is not None:
                hit = reduce(lambda a, b: a | b, (_same(v, kind, x) for x in values), F.lit(False))
                out.append(_found(~hit, place, key, F.coalesce(F.substring(F.try_variant_get(v, "$", "string"), 1, 80), kind)))
        out += self._object(s, v, kind, place, seen) + self._array(s, v, kind, place, seen) + self._scalar(s, v, kind, place)
        for part in s.get("allOf", []):
            out.append(self.findings(part, v, place, seen))
        if "anyOf" in s:
            fits = reduce(lambda a, b: a | b, (F.size(self.findings(part, v, place, seen)) == 0 for part in s["anyOf"]), F.lit(False))
            out.append(_found(~fits, place, "anyOf", "none of the alternatives fits"))
        if "not" in s:
            out.append(_found(F.size(self.findings(s["not"], v, place, seen)) == 0, place, "not", "what is ruled out fits"))
        return _all(out)

    def _if_there(self, schema: Any, v: Column, place: Column, seen: tuple[str, ...]) -> Column:
        return _let(v, lambda x: F.when(x.isNotNull(), self.findings(schema, x, place, seen)).otherwise(_none()))

    def _object(self, s: dict, v: Column, kind: Column, place: Column, seen: tuple[str, ...]) -> list[Column]:
        out, is_object = [], kind == "object"
        for name in s.get("required", []):
            out.append(_found(is_object & _member(v, name).isNull(), place, "required", name))
        for name, part in s.get("properties", {}).items():
            out.append(F.when(is_object, self._if_there(part, _member(v, name), F.concat(place, F.lit(f".{name}")), seen)).otherwise(_none()))
        members = lambda: F.try_variant_get(v, "$", "map<string,variant>")
        for key, wrong in (("minProperties", lambda n: n < s["minProperties"]), ("maxProperties", lambda n: n > s["maxProperties"])):
            if key in s:
                out.append(_found(is_object & wrong(F.size(members())), place, key, str(s[key])))
        if s.get("additionalProperties", True) is not True:
            known = [F.lit(k) for k in s.get("properties", {})]
            more = s["additionalProperties"]
            fresh = F.map_entries(F.map_filter(members(), lambda k, _: ~k.isin(*known) if known else F.lit(True)))
            if more is False:
                # in the order of names, as objects have none of their own
                each = F.transform(F.array_sort(F.transform(fresh, lambda e: e["key"])), lambda k: F.struct(place.alias("place"), F.lit("additionalProperties").alias("rule"), k.alias("detail")))
                out.append(F.when(is_object, each.cast(FINDING)).otherwise(_none()))
            else:
                each = F.flatten(F.transform(fresh, lambda e: self.findings(more, e["value"], F.concat(place, F.lit("."), e["key"]), seen)))
                out.append(F.when(is_object, each).otherwise(_none()))
        return out

    def _array(self, s: dict, v: Column, kind: Column, place: Column, seen: tuple[str, ...]) -> list[Column]:
        out, is_array = [], kind == "array"
        items = lambda: F.try_variant_get(v, "$", "array<variant>")
        for key, wrong in (("minItems", lambda n: n < s["minItems"]), ("maxItems", lambda n: n > s["maxItems"])):
            if key in s:
                out.append(_found(is_array & wrong(F.size(items())), place, key, F.concat(F.lit(f"{s[key]}, it has "), F.size(items()).cast("string"))))
        if "items" in s:
            each = F.transform(items(), lambda x, i: self.findings(s["items"], x, F.concat(place, F.lit("["), i.cast("string"), F.lit("]")), seen))
            out.append(F.when(is_array, F.flatten(each)).otherwise(_none()))
        return out

    def _scalar(self, s: dict, v: Column, kind: Column, place: Column) -> list[Column]:
        out = []
        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", _NUMBER)
        texts = {"minLength": lambda x: F.length(text) < x, "maxLength": lambda x: F.length(text) > x, "pattern": lambda x: ~text.rlike(x)}
        numbers = {"minimum": lambda x: number < x, "maximum": lambda x: number > x, "exclusiveMinimum": lambda x: number <= x, "exclusiveMaximum": lambda x: number >= x}
        for key, wrong in texts.items():
            if key in s:
                out.append(_found((kind == "string") & wrong(s[key]), place, key, str(s[key])))
        for key, wrong in numbers.items():
            if key in s:
                out.append(_found((kind == "number") & wrong(F.lit(Decimal(str(s[key]))).cast(_NUMBER)), place, key, F.concat(F.lit(f"{s[key]}, it is "), text)))
        return out


def compiled(schema: dict | bool, json: Column) -> Column:
    """The findings of a JSON text as array<struct<place, rule, detail>>: empty if it fits, NULL for NULL, one of rule json for text that is no JSON."""
    v = F.try_parse_json(json)
    inside = lambda x: F.when(x.isNull(), _found(F.lit(True), F.lit("$"), "json", "no JSON")).otherwise(_Compiler(schema if isinstance(schema, dict) else {}).findings(schema, x, F.lit("$")))
    return F.when(json.isNotNull(), _let(v, inside))


def findings(rows: DataFrame, id_col: str, json_col: str, schema: dict | bool) -> DataFrame:
    """(id, place, rule, detail): a row for each finding; rows that fit, and NULL, have none."""
    return rows.select(F.col(id_col), F.explode(compiled(schema, F.col(json_col))).alias("_f")).select(id_col, "_f.*")
