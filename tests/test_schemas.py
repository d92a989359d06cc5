"""Compiled JSON schemas against a plain validator, and shapes of types against a plain walk."""

import json
import random
import re

import pytest

from marlstone.errors import SpecError
from marlstone.operators import jsonschema, shapes

CHANGE = {
    "type": "object",
    "required": ["commandId", "operation"],
    "additionalProperties": False,
    "properties": {
        "commandId": {"type": "string", "minLength": 1, "maxLength": 4}, "operation": {"enum": ["create", "update", 7, None, True]}, "target": {"$ref": "#/$defs/reference"},
        "properties": {"type": "object", "minProperties": 1, "maxProperties": 2, "additionalProperties": {"type": ["integer", "null"], "minimum": -3, "exclusiveMaximum": 4}},
    },
}
SCHEMA = {
    "$schema": "x",
    "type": "object",
    "required": ["profileVersion", "changes"],
    "properties": {
        "profileVersion": {"const": 15},
        "changes": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"$ref": "#/$defs/change"}},
        "pick": {"anyOf": [{"type": "string", "pattern": "^#"}, {"type": "array", "items": {"type": "number", "exclusiveMinimum": 0, "maximum": 9.5}}]},
        "odd": {"allOf": [{"type": "integer"}, {"not": {"const": 3}}]}, "never": False, "any": True, "a b": {"type": "boolean"},
    },
    "$defs": {"change": CHANGE, "reference": {"type": "object", "properties": {"selector": {"type": "string", "pattern": "^#"}}}},
}


def kind(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object" if isinstance(v, dict) else "number"


def same(a, b):
    return kind(a) == kind(b) and a == b


def plain(s, v, place="$"):
    """(place, rule) of each finding."""
    if s is True:
        return []
    if s is False:
        return [(place, "false")]
    if "$ref" in s:
        s = SCHEMA["$defs"][s["$ref"].split("/")[-1]]
    k, out = kind(v), []
    add = lambda bad, rule: out.append((place, rule)) if bad else None
    if "type" in s:
        names = [s["type"]] if isinstance(s["type"], str) else s["type"]
        add(not any(n == k or n == "integer" and k == "number" and v == int(v) for n in names), "type")
    add("const" in s and not same(v, s.get("const")), "const")
    add("enum" in s and not any(same(v, x) for x in s.get("enum", [])), "enum")
    if k == "object":
        out += [(place, "required") for n in s.get("required", []) if n not in v]
        add(len(v) < s.get("minProperties", 0), "minProperties")
        add(len(v) > s.get("maxProperties", 99), "maxProperties")
        for n, part in s.get("properties", {}).items():
            out += plain(part, v[n], f"{place}.{n}") if n in v else []
        more = s.get("additionalProperties", True)
        for n in v:
            if n not in s.get("properties", {}):
                out += [(place, "additionalProperties")] if more is False else plain(more, v[n], f"{place}.{n}")
    if k == "array":
        add(len(v) < s.get("minItems", 0), "minItems")
        add(len(v) > s.get("maxItems", 99), "maxItems")
        for i, x in enumerate(v):
            out += plain(s.get("items", True), x, f"{place}[{i}]")
    if k == "string":
        add(len(v) < s.get("minLength", 0), "minLength")
        add(len(v) > s.get("maxLength", 99), "maxLength")
        add("pattern" in s and not re.search(s.get("pattern", ""), v), "pattern")
    if k == "number":
        add(v < s.get("minimum", v), "minimum")
        add(v > s.get("maximum", v), "maximum")
        add("exclusiveMinimum" in s and v <= s["exclusiveMinimum"], "exclusiveMinimum")
        add("exclusiveMaximum" in s and v >= s["exclusiveMaximum"], "exclusiveMaximum")
    for part in s.get("allOf", []):
        out += plain(part, v, place)
    add("anyOf" in s and all(plain(p, v, place) for p in s.get("anyOf", [])), "anyOf")
    add("not" in s and not plain(s.get("not", False), v, place), "not")
    return out


def made(rng, depth=0):
    names = ["profileVersion", "changes", "commandId", "operation", "target", "properties", "selector", "pick", "odd", "never", "any", "a b", "zz"]
    roll = rng.random()
    if depth < 4 and roll < 0.35:
        return {n: made(rng, depth + 1) for n in rng.sample(names, rng.randrange(5))}
    if depth < 4 and roll < 0.55:
        return [made(rng, depth + 1) for _ in range(rng.randrange(5))]
    return rng.choice([None, True, False, 0, 3, 15, 7, -4, 2.5, 15.0, 9.75, "", "#a", "create", "toolong", "7", "é日"])


def batch(rng):
    doc = made(rng)
    if rng.random() < 0.8:
        doc = {"profileVersion": rng.choice([15, 15.0, 14, "15"]), "changes": [{"commandId": rng.choice(["c", "", "toolong", 3]), "operation": rng.choice(["create", 7, "7", None, True, 1]), "properties": made(rng, 2), "target": made(rng, 3)} if rng.random() < 0.8 else made(rng, 2) for _ in range(rng.randrange(5))]}
        doc |= {n: made(rng, 2) for n in rng.sample(["pick", "odd", "never", "any", "a b", "zz"], rng.randrange(4))}
    return doc


def test_against_a_plain_validator(spark):
    rng = random.Random(7)
    docs = [batch(rng) for _ in range(400)] + [{"profileVersion": 15, "odd": 3}, {"odd": 4}, {"odd": 3.0}, {"odd": "3"}]
    texts = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(1000, "{"), (1001, None), (1002, "")]
    got = sorted((r.id, r.place, r.rule) for r in jsonschema.findings(spark.createDataFrame(texts, "id long, j string"), "id", "j", SCHEMA).collect())
    want = sorted([(i, *f) for i, d in enumerate(docs) for f in plain(SCHEMA, d)] + [(1000, "$", "json"), (1002, "$", "json")])
    assert got == want and {r for *_, r in want} >= {"type", "const", "enum", "required", "minItems", "maxItems", "pattern", "anyOf", "not", "false", "additionalProperties", "minimum", "exclusiveMaximum", "minProperties"}


def test_no_python_runs(spark):
    df = jsonschema.findings(spark.createDataFrame([(1, "{}")], "id long, j string"), "id", "j", SCHEMA)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in jsonschema.findings(spark.createDataFrame([(1, "{}")], "id long, j string"), "id", "j", True).collect()] == []


@pytest.mark.parametrize(
    "schema",
    [{"typo": 1}, {"type": "text"}, {"$ref": "#/$defs/x"}, {"$ref": "other.json"}, {"enum": [{"a": 1}]}, {"properties": {"it's": True}}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, {"items": 3}],
)
def test_wrong_schemas_are_errors(spark, schema):
    with pytest.raises(SpecError):
        jsonschema.findings(spark.createDataFrame([(1, "{}")], "id long, j string"), "id", "j", schema)


def test_shapes(spark):
    docs = [
        {"$type": "report", "name": "a", "columns": [{"alias": "x", "width": 1}, {"alias": None}], "condition": {"$type": "leaf", "operator": "equal"}},
        {"$type": "report", "name": "b", "columns": [], "note": "z" * 100},
        {"loose": {"$type": "leaf", "operator": "equal", "value": [[1], ["s"]]}, "untyped": 1},
        [{"$type": "leaf", "operator": "isNull"}, {"$type": 5, "operator": "no type"}],
    ]
    texts = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(10, "{"), (11, None), (12, "3")]
    got = {(r.type, r.path): (r.kinds, r.objects, r.present, r.optional, r.repeated, r.nullable, r.vocabulary) for r in shapes.type_shapes(spark.createDataFrame(texts, "k long, j string"), "k", "j", often=1).collect()}
    assert got[("leaf", "operator")] == (["string"], 3, 3, False, False, False, ["equal", "isNull"])
    assert got[("leaf", "value[*][*]")] == (["number", "string"], 3, 1, True, True, False, None)
    assert got[("report", "columns[*].alias")] == (["null", "string"], 2, 1, True, True, True, ["x"])
    assert got[("report", "condition")] == (["object"], 2, 1, True, False, False, None) and ("report", "condition.operator") not in got
    assert got[("report", "note")] == (["string"], 2, 1, True, False, False, None)
    assert got[("report", "name")][-1] == ["a", "b"] and {t for t, _ in got} == {"leaf", "report"}
    few = {(r.type, r.path): r.vocabulary for r in shapes.type_shapes(spark.createDataFrame(texts, "k long, j string"), "k", "j", most=1, often=2).collect()}
    assert few[("leaf", "operator")] is None and few[("leaf", "$type")] == ["leaf"] and few[("report", "columns[*].alias")] is None


def test_shapes_of_keys_with_points_and_brackets(spark):
    docs = [(1, '{"$type": "t", "a.b": 1, "a": {"b": "x"}, "c[0]": {"d": 1}}'), (2, '{"$type": "t", "a": {"b": 2}}')]
    got = {r.path: (r.kinds, r.present, r.repeated) for r in shapes.type_shapes(spark.createDataFrame(docs, "k long, j string"), "k", "j").collect()}
    assert got["a.b"] == (["number", "string"], 2, True) and got["c[0].d"] == (["number"], 1, False) and got["a"] == (["object"], 2, False)


def test_shapes_are_counted_where_documents_lie(spark):
    docs = [{"$type": "a", "x": [{"y": i}] * 3, "in": [{"$type": "b", "s": f"v{i % 30}"}]} for i in range(60)]
    deep = '{"$type": "d", "a": ' + "[" * 100 + "1" + "]" * 100 + "}"
    # one id for all: objects are told apart by where they are
    texts = spark.createDataFrame([(1, json.dumps(d)) for d in docs] + [(1, deep), (1, '{"$type": "a", "x": 1, "x": 2}'), (1, '{"$type": "\\u0062", "s": "\\ud800"} rest')], "k long, j string").repartition(3)
    tracker, group = spark.sparkContext.statusTracker(), "shapes-jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = {(r.type, r.path): (r.kinds, r.objects, r.present, r.repeated, r.vocabulary) for r in shapes.type_shapes(texts, "k", "j", often=1).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) < 30  # not some for each level
    assert got[("a", "x[*].y")] == (["number"], 60, 60, True, None) and got[("a", "in[*]")] == (["object"], 60, 60, True, None)
    assert got[("b", "s")] == (["string"], 61, 61, False, None) and got[("b", "$type")][-1] == ["b"]
    assert got[("d", "a" + "[*]" * 100)] == (["number"], 1, 1, True, None) and len(got) == 6 + 2 + 102


def test_shapes_of_more_paths_than_a_task_holds(spark, monkeypatch):
    docs = [{"$type": f"t{i % 7}", "p": "ab"[i % 2], f"k{i % 5}": None} for i in range(70)]
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k long, j string").coalesce(1)
    want = sorted(map(str, shapes.type_shapes(texts, "k", "j").collect()))
    monkeypatch.setattr(shapes, "HELD_PATHS", 4)
    assert sorted(map(str, shapes.type_shapes(texts, "k", "j").collect())) == want and len(want) == 7 * 7
