"""Catalogues against plain code, and every rule of proposals and evidence."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from marlstone.operators import catalogues, proposals


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_catalogues(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice([None, 1, 2, 3]), i) for i in range(200)] + [(f"z{i:02d}", "x", 9, 500 + i) for i in range(40)]
    df = spark.createDataFrame(data, "caller string, callee string, v int, id int")
    use = {}
    for a, b, *_ in data:
        if a and b:
            use.setdefault(b, set()).add(a)
    assert rows(catalogues.inverted(df, "caller", "callee")) == sorted(((k, sorted(v), len(v)) for k, v in use.items()), key=str)
    assert rows(catalogues.inverted(df, "caller", "callee", 4)) == sorted(((k, sorted(v)[:4], len(v)) for k, v in use.items()), key=str)
    best = {}
    for a, _, v, i in data:
        best.setdefault(a, None)
        if v is not None and (best[a] is None or (v, i) > best[a]):
            best[a] = (v, i)
    assert rows(catalogues.argmax(df.withColumn("id", F.when(F.col("v").isNotNull(), F.col("id"))), ["caller"], "id", ["v", "id"], "m")) == sorted(((k, v and v[1]) for k, v in best.items()), key=str)
    assert catalogues.owned(df, "caller", "^[ab]$", "callee", "^x").count() == sum(1 for a, b, *_ in data if a in ("a", "b") and b != "x")
    assert rows(catalogues.tagged(df, "id", "caller", ["Z", "a", "zz"])) == [("Z", 40), ("a", sum(1 for a, *_ in data if a == "a"))]
    where = {}
    for a, _, _, i in data:
        if a and len(a) > 1 and a < "z10":
            where.setdefault(a, []).append(i)
    few = catalogues.sites(df.where("caller < 'z10'"), "caller", "id", shortest=2, most=1)
    assert rows(few) == sorted((k, sorted(v)[:1], len(v)) for k, v in where.items())


def test_vocabulary_and_counts(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "z"), (6, "z")], "k int, l string")
    b = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3"), (4, "4"), (5, None), (6, "3"), (7, "7")], "k int, r string")
    assert rows(catalogues.vocabulary(a, b, "k", "l", "r")) == [("x", "1", 1, 0.5, False), ("x", "2", 1, 0.5, False), ("y", "3", 1, 1.0, False), ("z", "3", 1, 1.0, False)]
    assert rows(catalogues.vocabulary(a.where("k < 4"), b, "k", "l", "r"))[-1] == ("y", "3", 1, 1.0, True)
    s = spark.createDataFrame([("1",), ("2",), ("3",)], "sid string")
    one, two = spark.createDataFrame([("1",), ("1",), ("9",), (None,)], "a string"), spark.createDataFrame([("1",), ("1",), ("2",)], "b string")
    assert rows(catalogues.reconciled(s, "sid", {"x": (one, "a"), "y": (two, "b")})) == [("1", 2, 2, True), ("2", 0, 1, False), ("3", 0, 0, True)]
    assert rows(catalogues.reconciled(s, "sid", {"x": (one, "a"), "y": (two, "b")}, F.col("sid") != "2"))[1] == ("2", 0, 1, None)


def test_tables_and_copies(spark):
    declared = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "table string")
    used = spark.createDataFrame([("A", "p"), ("A", "o"), ("A", "p"), ("a", "p"), (None, "p")], "table string, place string")
    assert rows(catalogues.table_catalogue(declared, used)) == [("A", ["o", "p"], True, "CrossVerified"), ("B", [], True, "Verified"), ("a", ["p"], False, "Verified")]
    texts = ["x", "y", None, "", "x", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert sorted((r.first_id, r.n) for r in catalogues.copies(df, "t", "id").collect()) == sorted((min(i for i, t in enumerate(texts) if (t or "") == k), n) for k, n in Counter(t or "" for t in texts).items())
    assert rows(catalogues.observed_columns({"d": df, "e": df.limit(0)})) == [("d", "id", 6), ("d", "t", 5), ("e", "id", 0), ("e", "t", 0)]


def proposal(**more):
    return {"proposal": {"scope": {"allow": ["report:#X", "field:*"]}, **more}}


def test_proposals(spark):
    docs = [
        proposal(), proposal(gates=["lint", "order"], system="1"), proposal(gates=None, system=""), {}, {"proposal": []}, {"proposal": {}}, {"proposal": {"scope": {"allow": []}}}, {"proposal": {"scope": {"allow": "report:#X"}}},
        {"proposal": {"scope": {"allow": ["plain", 7, "thing:#X", "report:X", "report:#a:b"]}}}, proposal(gates="lint"), proposal(gates=["lint", "none"]), proposal(system="2"), proposal(system=3),
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(99, "no json"), (98, None)], "id int, j string")
    types = spark.createDataFrame([("report",), ("field",), ("report",)], "objectType string")
    known = spark.createDataFrame([("1", True, True), ("2", False, True)], "system string, allowed boolean, indexed boolean")
    got = {}
    for r in proposals.proposal_findings(df, "id", "j", types, known).collect():
        got.setdefault(r.id, set()).add((r.place.removeprefix("$.proposal"), r.rule))
    allow = ".scope.allow"
    assert got == {
        3: {("$", "required")}, 4: {("", "type")}, 5: {("", "required")}, 6: {(allow, "minItems")}, 7: {(allow, "type")},
        8: {(f"{allow}[0]", "pattern"), (f"{allow}[1]", "type"), (f"{allow}[2]", "objectType"), (f"{allow}[3]", "selector")},
        9: {(".gates", "type")}, 10: {(".gates[1]", "enum")}, 11: {(".system", "systemNotAllowed")}, 12: {(".system", "systemNotAllowed"), (".system", "systemNotIndexed")}, 99: {("$", "json")},
    }


def test_evidence(spark):
    good = {"ac": "AC-1", "basis": "seen", "verdict": "pass"}
    docs = [
        {"evidence": {"acceptance": [good, {**good, "ac": "AC-2", "verdict": "partial"}]}}, {"evidence": {"acceptance": [good]}}, {"evidence": {"acceptance": []}}, {"evidence": {}}, {},
        {"evidence": {"acceptance": [{**good, "verdict": "fail"}, {**good, "ac": "AC-2", "basis": ""}, 3, {"ac": "AC-2", "verdict": "sure"}]}},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, j string")
    tasks = spark.createDataFrame([(i, "AC-1 and AC-2, AC-1") for i in range(6)] + [(77, "AC-3")], "id int, t string")
    got = {}
    for r in proposals.evidence_findings(df, "id", "j", tasks, "t").collect():
        got.setdefault(r.id, set()).add((r.place.removeprefix("$.evidence"), r.rule, r.detail if r.rule == "uncovered" else None))
    at = ".acceptance"
    assert got == {
        1: {(at, "uncovered", "AC-2")}, 2: {(at, "minItems", None), (at, "uncovered", "AC-1"), (at, "uncovered", "AC-2")}, 3: {("", "required", None)}, 4: {("$", "required", None)},
        5: {(f"{at}[0].verdict", "not", None), (f"{at}[1].basis", "minLength", None), (f"{at}[2]", "type", None), (f"{at}[3]", "required", None), (f"{at}[3].verdict", "enum", None)},
    }
