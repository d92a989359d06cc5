"""Matching, merging, hierarchies, JSON, batches, evidence, events, files: each with a negative case."""

import gzip
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from marlstone.errors import SpecError
from marlstone.functions import text as t
from marlstone.operators import audit, batch, evidence, hierarchy, jsonwalk, match, merge, model, retrieve
from marlstone.sources import documents, formats, legacy, sinks
from marlstone.streaming import workflow


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_cascade_keeps_every_row(spark):
    rng = random.Random(1)
    side = lambda n: [(i, rng.choice([None, "", *"abcdefgh"]), rng.choice("pqrs") + str(rng.randrange(6)), i) for i in range(n)]
    left, right = side(40), side(30)
    got = match.cascade_match(spark.createDataFrame(left, "id long, k1 string, k2 string, pos long"), spark.createDataFrame(right, "id long, k1 string, k2 string, pos long"), ["k1", "k2"], "id", "pos").collect()
    free_l, free_r, want = {r[0]: r for r in left}, {r[0]: r for r in right}, []
    for c, key in ((1, "k1"), (2, "k2")):
        used = []
        for i, r in list(free_l.items()):
            hits = [j for j, s in free_r.items() if r[c] and s[c] == r[c] and j not in [u[1] for u in used]]
            same = [j for j, s in free_r.items() if r[c] and s[c] == r[c]]
            if len(same) == 1 and hits:
                used.append((i, hits[0], key))
        for i, j, _ in used:
            del free_l[i], free_r[j]
        want += used
    want += [(i, None, None) for i in free_l] + [(None, j, None) for j in free_r]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_folds(spark):
    df = spark.createDataFrame([("  يك‌دو\xa0 ABC‏ ",)], "s string")
    r = df.select(t.fold_match(F.col("s")).alias("m"), t.fold_search(F.col("s")).alias("s"), t.fold_caption(F.col("s")).alias("c")).first()
    assert r.m == "یک دو abc" and r.s == "  یک‌دو\xa0 abc‏ "


def test_text(spark):
    df = spark.createDataFrame([("Password = x; y",), ("select a from b where c",), ("C:\\a\\b.txt",), ("file.xml",), ("met_x",), ("A.B.C",), ("x" * 5000,), (None,)], "s string")
    c = F.col("s")
    assert [r[0] for r in df.select(t.classify(c)).collect()] == ["other", "sql", "path", "fileName", "table", "typeOrConfigKey", "other", None]
    assert df.select(t.redact(c)).first()[0] == "Password =***REDACTED***; y"
    one = spark.createDataFrame([("---\na: 1\n---\nbody AC-2 AC-1 AC-2", "", None, "TRUE", "x")], "a string, b string, c string, d string, e string")
    r = one.select(t.front_matter(F.col("a")), t.acceptance_ids(F.col("a")), t.first_non_empty(F.col("b"), F.col("c"), F.col("d")), t.tri_state(F.col("d")), t.tri_state(F.col("c")), t.safe_long(F.col("e"))).first()
    assert tuple(r) == ("a: 1", ["AC-1", "AC-2"], "TRUE", True, None, None)


def test_owners_and_cycles(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (10, 12), (11, 10), (12, 11), (13, 10), (20, 99)], "id long, up long")
    owned = spark.createDataFrame([(1, "A"), (3, "B"), (10, "C"), (20, "D")], "id long, owner string")
    got, cyclic = hierarchy.owners(nodes, owned, "id", "up")
    assert rows(got) == [(1, "A"), (2, "A"), (20, "D"), (3, "A"), (4, "A")]
    assert sorted(r.id for r in cyclic.collect()) == [10, 11, 12, 13]
    assert rows(hierarchy.descend(nodes, spark.createDataFrame([(10,)], "id long"), "id", "up")) == [(10, 0, 10), (11, 1, 10), (12, 2, 10), (13, 1, 10)]


def test_merges(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None), (None, "n")], "k long, v string"), spark.createDataFrame([(2, "y"), (3, "z")], "k long, v string")
    assert rows(merge.full_merge(a, b, "k", prefer=["v"])) == [(1, "x", "a"), (2, "y", "both"), (3, "z", "b"), (None, "n", "a")]
    log = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "c"), (2, 1, None, None)], "k long, at long, v string, w string")
    assert rows(merge.last_known(log, "k", "at", ["v", "w"])) == [(1, "a", "c"), (2, None, None)]
    p = spark.createDataFrame([(1, '{"v": null}'), (2, "{}")], "k long, patch string")
    assert rows(merge.patched(a.where("k is not null"), p, "k", ["v"])) == [(1, None), (2, None)]
    assert rows(match.scope(a, b.limit(0), "k"))[0][3] == "unknown"


def test_json(spark):
    doc = {"id": 1011413550000000100, "a": [{"id": 7, "v": None}, {"v": True}], "$type": "x"}
    w = jsonwalk.walk(spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, None)], "k long, j string"), "k", "j")
    got = {(r.id, r.path, r.value, r.owner, r.type) for r in w.collect()}
    assert (1, "$.id", "1011413550000000100", "1011413550000000100", "number") in got
    assert (1, "$.a[*].v", None, "7", "null") in got and (1, "$.a[*].v", "true", "1011413550000000100", "boolean") in got
    assert (2, "$", None, None, "invalid") in got and not any(g[0] == 3 for g in got)
    assert rows(jsonwalk.references(jsonwalk.walk(spark.createDataFrame([(1, '{"items":["#a","b"],"x":"#c"}')], "k long, j string"), "k", "j"), ["items"])) == [(1, "$.items[*]", "#a")]


def command(pos, op="create", temp=None, parent=None, target=None, props="{}", kind="report", cid=None, b=1):
    return (b, pos, cid or f"c{pos}", op, kind, temp, target, parent, props)


SCHEMA = "batch_id long, pos long, commandId string, operation string, objectType string, tempId string, target struct<selector string, tempId string>, parent struct<selector string, tempId string>, properties string"


def test_batches(spark):
    make = lambda *c: spark.createDataFrame(list(c), SCHEMA)
    lint = lambda *c: sorted(r.message for r in batch.lint(make(*c), ["report", "folder"]).collect() if r.severity == "error")
    root = ("#e", None)
    assert lint(command(1, parent=root)) == []
    assert lint(command(1, parent=root, cid="x"), command(2, parent=root, cid="x")) == ["commandId is used twice: x"]
    assert lint(command(1, op="update", temp="t", target=("#a", None))) == ["tempId is for create only"]
    assert lint(command(1, parent=(None, "gone"))) == ["tempId is never created: gone"]
    assert lint(command(1, parent=root, props='{"rowId": 1}')) == ["runtime key: rowId"]
    assert lint(command(1, parent=("e", None))) == ["not a selector: e"]
    assert lint(command(1, parent=root, kind=None)) == ["objectType is missing"]
    order = lambda *c: sorted(r.message for r in batch.order_gate(make(*c), spark.createDataFrame([("folder", 1), ("report", 2)], "objectType string, rank int")).collect())
    assert order(command(1, temp="a", kind="folder"), command(2, parent=(None, "a"))) == []
    assert order(command(1, parent=(None, "a"), kind="folder"), command(2, temp="a", kind="folder")) == ["parent is created later: a"]
    assert order(command(1), command(2, kind="other"), command(3, kind="folder")) == ["stands after its dependants"]
    paths = make(command(1, parent=root, props='{"field": {"items": ["#in", "#out"]}}'))
    assert [r.message for r in batch.selector_gate(paths, spark.createDataFrame([("#e",), ("#in",)], "selector string")).collect()] == ["unknown selector: #out"]
    heads = spark.createDataFrame([(1, 15, None, 2), (2, 14, "Later", 0)], "batch_id long, profileVersion int, errorPolicy string, n_changes int")
    assert sorted(r.message for r in batch.header_findings(heads).collect()) == ["no changes", "profileVersion must be 15", "unknown errorPolicy"]


def test_plans(spark):
    nodes = spark.createDataFrame([(1, i) for i in range(6)], "batch_id long, node long")
    edges = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 2, 0), (1, 4, 5), (1, 5, 4)], "batch_id long, node long, needs long")
    done, cyclic = batch.plan_levels(nodes, edges)
    assert rows(done) == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 0)] and rows(cyclic) == [(1, 4), (1, 5)]
    assert rows(batch.skipped(edges, nodes.where("node = 0"))) == [(1, 1), (1, 2)]


def test_evidence(spark):
    df = spark.createDataFrame([("a", "IL"), ("a", "ExportSample"), ("b", "IL"), ("b", "CallGraph"), ("c", "Inference"), ("d", "UserProvided")], "k string, s string")
    assert {r.k: r.confidence for r in evidence.confidence(df, ["k"], "s").collect()} == {"a": "CrossVerified", "b": "Verified", "c": "Inferred", "d": "Unknown"}
    p = spark.createDataFrame([("a", "Verified"), ("b", "Inferred")], "k string, confidence string")
    s = spark.createDataFrame([("a", "Inferred"), ("b", "Verified")], "k string, confidence string")
    assert [r.k for r in evidence.promotions(p, s, "k").collect()] == ["a"]


def test_retrieval(spark):
    df = spark.createDataFrame([(1, "Report"), (2, "Report two"), (3, None)], "id long, caption string")
    assert [r.id for r in retrieve.retrieve(df, ["caption"], "REPORT").collect()] == [1]
    assert [r.id for r in retrieve.retrieve(df, ["caption"], "two").collect()] == [2]
    assert retrieve.retrieve(df, ["caption"], "none").count() == 0
    assert {(r.id, r.status) for r in retrieve.find(df, "id", "caption", "rep").collect()} == {(1, "ambiguous"), (2, "ambiguous")}
    assert [(r.id, r.status) for r in retrieve.find(df, "id", "caption", "Report").collect()] == [(1, "found")]
    with pytest.raises(SpecError):
        retrieve.page(df, ["id"], 0, 101)


def test_gates(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    good, bad = audit.gate("g", df.limit(0)), audit.gate("b", df, label="x").drop("shown")
    with pytest.raises(SpecError):
        sinks.write_pack({"t": df}, str(tmp_path / "p"), audit.all_passed([good, bad]))
    assert not (tmp_path / "p").exists()
    sinks.write_pack({"t": df, "u": df}, str(tmp_path / "p"), good)
    sinks.write_pack({"t": df}, str(tmp_path / "p"), good)
    assert sorted(x.name for x in (tmp_path / "p").iterdir() if x.is_dir()) == ["t"]
    assert sinks.markdown_table(spark.createDataFrame([("a|b\nc", None)], "p string, q string")) == "| p | q |\n| --- | --- |\n| a\\|b c |  |\n"


def test_files(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("manifest.json", json.dumps({"format": "F", "profileVersion": 15}))
        f.writestr("a/b.json", "\ufeff{}")
        f.writestr("c.json", "{")
        f.writestr("d.png", b"\x89")
    xml = '<NewDataSet><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="NewDataSet"><xs:complexType><xs:choice><xs:element name="T_x0020_A"><xs:complexType><xs:sequence><xs:element name="ID" type="xs:long"/><xs:element name="Password" type="xs:string" minOccurs="0"/></xs:sequence></xs:complexType></xs:element></xs:choice></xs:complexType></xs:element></xs:schema><diffgr:diffgram xmlns:diffgr="urn:d"><NewDataSet><T_x0020_A><ID>1011413550000000100</ID><Password>p</Password></T_x0020_A><T_x0020_A><ID>2</ID></T_x0020_A></NewDataSet></diffgr:diffgram></NewDataSet>'
    bodies = {"x.zip": b'\xef\xbb\xbf {"manifest": {"format": "F"}}', "a.zip": z.getvalue(), "p.metaexport": gzip.compress(xml.encode()), "bad.gz": b"\x1f\x8bxx", "n.bin": b"\x00\x01"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    files = formats.discover(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: r for r in formats.detect(files).collect()}
    assert (got["x.zip"].physical, got["x.zip"].logical, len(got["x.zip"].warnings)) == ("JSON", "JsonArtifact", 1)
    assert (got["a.zip"].logical, got["a.zip"].variant, got["a.zip"].members) == ("JsonArtifact", "15", 4)
    assert got["p.metaexport"].logical == "LegacyPackage" and len(got["bad.gz"].errors) == 1
    assert got["n.bin"].physical == "Binary"
    docs = {r.member: r for r in formats.json_documents(files.where("path like '%a.zip'")).collect()}
    assert set(docs) == {"manifest.json", "a/b.json", "c.json"} and docs["c.json"].error == "not JSON" and docs["a/b.json"].json == "{}"
    schema, cells = legacy.read_packages(files.where("path like '%export' or path like '%bad.gz'"))
    assert {(r.table, r.column, r.type, r.nullable) for r in schema.collect()} == {("T A", "ID", "long", False), ("T A", "Password", "string", True)}
    assert [tuple(r)[1:] for r in legacy.table_rows(cells, "T A", ["ID", "Password"]).orderBy("row").collect()] == [(0, "1011413550000000100", "***REDACTED***"), (1, "2", None)]
    assert cells.where("error is not null").count() == 1 and legacy.row_counts(cells).first().rows == 2


def test_markdown(spark):
    df = spark.createDataFrame([("d", "# One\n`a` and `b`\n## Two\n| x | y |\n|---|---|\n| 1 | `c` |")], "id string, body string")
    lines = documents.number_lines(df, "id", "body")
    assert {(r.line, r.section, r["name"]) for r in documents.quoted_names(lines).collect()} == {(2, "One", "a"), (2, "One", "b"), (6, "Two", "c")}
    assert [r.cells for r in documents.table_cells(lines).orderBy("line").collect()] == [["x", "y"], ["1", "`c`"]]


def test_state_machine_invariants():
    targets = {x for v in workflow.EDGES.values() for x in v}
    assert targets <= {*workflow.EDGES, *workflow.TERMINAL} and set(workflow.TERMINAL) <= targets
    assert not set(workflow.TERMINAL) & set(workflow.EDGES) and len(workflow.EDGES) == 13


def test_state_machine(spark, tmp_path):
    log = [("t1", "new"), ("t1", "architecture"), ("t1", "blocked"), ("t1", "ready"), ("t1", "architecture"), ("t2", "ready"), ("t2", "new")]
    path = tmp_path / "log"
    path.mkdir()
    body = [json.dumps({"at": f"2024-01-01T00:00:{i:02d}Z", "task": k, "event": "state.changed", "to": s}) for i, (k, s) in enumerate(log)]
    (path / "a.json").write_text("\n".join([*body, "{broken"]))
    assert workflow.read_events(spark, str(path)).where("_corrupt is not null").select("at", "_corrupt").collect()[0]["at"] is None
    judged = workflow.run_state_machine(workflow.stream_events(spark, str(path)))
    q = judged.writeStream.format("memory").queryName("judged").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = [(r.task, r.state, r.accepted) for r in spark.table("judged").orderBy("task", "at").collect()]
    assert got == [("t1", "new", True), ("t1", "architecture", True), ("t1", "blocked", True), ("t1", "ready", False), ("t1", "architecture", True), ("t2", "ready", False), ("t2", "new", True)]
    b = workflow.board(workflow.run_state_machine(workflow.stream_events(spark, str(path))), str(tmp_path / "board"), str(tmp_path / "cp")).start()
    b.processAllAvailable()
    b.stop()
    assert rows(workflow.read_board(spark, str(tmp_path / "board")).select("task", "state")) == [("t1", "architecture"), ("t2", "new")]
    edges = workflow.edge_rows(spark)
    batch_events = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(log)], "i int, task string, state string")
    assert workflow.transitions(batch_events, "task", "state", ["i"], edges, back="blocked").where("legal").count() == 4


def test_mixed_arrays(spark):
    doc = [{"$type": "x", "p": 1}, {"$type": "y", "q": 2, "in": [{"$type": "x", "r": 3}]}]
    w = jsonwalk.walk(spark.createDataFrame([(1, json.dumps(doc))], "k long, j string"), "k", "j")
    assert rows(jsonwalk.type_catalogue(w)) == [("x", 2, ["$type", "p", "r"]), ("y", 1, ["$type", "in", "q"])]
    samples = {r.path: r.samples for r in jsonwalk.path_catalogue(w, 1).collect()}
    assert samples["$[*].p"] == [1]


def test_board_survives_a_broken_version(spark, tmp_path):
    path = tmp_path / "board"
    with pytest.raises(SpecError):
        workflow.read_board(spark, str(path))
    spark.createDataFrame([("t1", "ready")], "task string, state string").write.parquet(f"{path}/version={1:012d}")
    (path / f"version={2:012d}").mkdir()  # a crash before _SUCCESS
    assert rows(workflow.read_board(spark, str(path))) == [("t1", "ready")]


def test_placeholders():
    assert model.substituted({"a": ["{{x}}", "b", {"c": "{{y}}"}]}, {"x": 1, "y": None}) == {"a": [1, "b", {"c": None}]}
    with pytest.raises(SpecError):
        model.substituted(["{{z}}"], {})


def test_walk_reads_its_documents_once_and_knows_types(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(k):
        seen.add(1)
        return k

    docs = spark.createDataFrame([(1, '{"$type": "a", "in": {"x": [true, {"$type": 5, "y": null}]}}'), (2, "{")], "k long, j string")
    w = jsonwalk.walk(docs.withColumn("k", F.udf(counted, "long")("k")), "k", "j", type_key="$type")
    got = {r.place: (r.type, r.of, r.around, r.within) for r in w.collect() if r.id == 1}
    assert seen.value == 2
    assert got["$"] == ("object", None, None, None) and got["$.in.x[0]"] == ("boolean", "a", "$", "$") and got["$.in.x[1]"] == ("object", "a", "$", "$")
    assert got["$.in.x[1].y"] == ("null", "5", "$.in.x[1]", "$.in.x[*]")
    assert rows(jsonwalk.type_catalogue(w)) == [("5", 1, ["$type", "y"]), ("a", 1, ["$type", "in"])]
    strings = jsonwalk.walk(docs, "k", "j", type_key="$type", texts_only=True)
    assert {r.of for r in strings.where("key = 'y'").collect()} == {"a"}


def test_json_types_hold_the_schema_once(spark):
    e = spark.createDataFrame([(t,) for t in ('{"a": 1}', "[]", "{}", "1", "1.5", "1e300", '""', "false", "null")], "j string").select(jsonwalk.json_type(F.parse_json("j")).alias("t"))
    assert [r.t for r in e.collect()] == ["object", "array", "object", "number", "number", "number", "string", "boolean", "null"]
    assert str(jsonwalk.json_type(F.col("v"))).count("schema_of_variant") == 1


def test_diff_groups_both_versions_at_once(spark):
    old = spark.createDataFrame([(1, '{"a": 1, "b": null}'), (2, "{"), (3, '{"a": [1, 2]}')], "k long, j string")
    new = spark.createDataFrame([(1, '{"a": 2}'), (2, "{"), (3, '{"a": [2, 1]}')], "k long, j string")
    got = jsonwalk.structural_diff(old, new, "k", "j")
    assert rows(got.select("id", "path", "change", "old", "new")) == [(1, "$.a", "changed", '["1"]', '["2"]'), (1, "$.b", "removed", '["null"]', None)]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_scope_conflicts_bound_a_task(spark, monkeypatch):
    monkeypatch.setattr(workflow, "HELD_ROWS", 4)
    held = spark.createDataFrame([(t, s) for t in range(10) for s in (t % 3, 100 + t) for _ in range(2)], "task long, scope long")
    states = spark.createDataFrame([(t, "integrated" if t == 9 else "ready") for t in range(10)], "task long, state string")
    got = workflow.scope_conflicts(held, states)
    assert rows(got) == [(0, 3), (1, 3), (2, 3)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [task") == 2
