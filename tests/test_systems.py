"""Assignment to systems by every rule, pairs of names and numbers of evidence against plain code."""

import random

from marlstone.operators import evidence, match, systems

SYSTEMS = [("1", "100"), ("2", "200"), ("3", None)]
ENTITIES = [("10", "1"), ("20", "2"), ("30", None), ("40", "9"), ("50", "1"), ("50", "2")]
FOLDERS = [("100", None), ("101", "100"), ("102", "101"), ("200", "102"), ("201", "200"), ("300", None), ("301", "302"), ("302", "301")]
COLUMNS = "collection string, id string, systemId string, entityId string, _ownerId string, sourceEntity string, targetEntity string, targetObjectId string, targetId string"
ROWS = {
    ("fields", "own", "2", "10", None, None, None, None, None): ("own", ["2"], "assigned"),
    ("fields", "own unknown", "7", "10", None, None, None, None, None): (None, [], "unassigned"),
    ("entities", "10", None, None, None, None, None, None, None): ("entity", ["1"], "assigned"),
    ("entities", "40", None, None, None, None, None, None, None): (None, [], "unassigned"),
    ("views", "by entity", None, "20", "10", None, None, None, None): ("owner", ["2"], "assigned"),
    ("workflows", "by owner", None, "", "10", None, None, None, None): ("owner", ["1"], "assigned"),
    ("fields", "two", None, "50", None, None, None, None, None): ("owner", ["1", "2"], "shared"),
    ("fields", "nobody", None, None, None, None, None, None, None): (None, [], "unassigned"),
    ("relationDefs", "both", None, None, None, "10", "20", None, None): ("ends", ["1", "2"], "shared"),
    ("relationDefs", "one", None, None, "10", "30", "99", None, None): ("ends", ["1"], "assigned"),
    ("navigation", "102", None, None, None, None, None, None, None): ("folder", ["1"], "assigned"),
    ("navigation", "201", None, None, None, None, None, None, None): ("folder", ["1"], "assigned"),  # the topmost root folder above has it
    ("navigation", "300", None, None, None, None, None, None, None): (None, [], "unassigned"),
    ("navigation", "301", None, None, None, None, None, None, None): (None, [], "unassigned"),
    ("code", "target", None, None, "10", None, None, "20", "10"): ("target", ["2"], "assigned"),
    ("commands", "target id", None, None, "10", None, None, "", "20"): ("target", ["2"], "assigned"),
    ("webServices", "target owner", None, None, "10", None, None, None, None): ("target", ["1"], "assigned"),
    ("other", "x", None, "10", "10", "10", "10", "10", "10"): (None, [], "unassigned"),
    (None, "y", None, "10", None, None, None, None, None): (None, [], "unassigned"),
    ("other", "z", "3", None, None, None, None, None, None): ("own", ["3"], "assigned"),
}


def given(spark, known=SYSTEMS):
    return spark.createDataFrame(known, "id string, rootFolderId string"), spark.createDataFrame(ENTITIES, "id string, systemId string"), spark.createDataFrame(FOLDERS, "id string, parentId string")


def test_every_rule_and_every_row(spark):
    rows = spark.createDataFrame([*ROWS, *ROWS], COLUMNS)
    out = systems.assigned(rows, *given(spark))
    got = out.collect()
    assert len(got) == 2 * len(ROWS) and out.columns[: len(rows.columns)] == rows.columns
    for r in got:
        assert (r.rule, r.systems, r.state) == ROWS[tuple(r)[: len(rows.columns)]], r.id
    counts = {r.collection: tuple(r)[1:] for r in systems.coverage(out).collect()}
    assert counts["relationDefs"] == (4, 4, 2) and counts["fields"] == (8, 4, 2) and counts["navigation"] == (8, 4, 0)


def test_thirty_fields_and_one_system(spark):
    fields = spark.createDataFrame([("fields", str(i), "10" if i < 30 else "20") for i in range(31)], "collection string, id string, entityId string")
    got = [r.systems for r in systems.assigned(fields, *given(spark)).collect()]
    assert got.count(["1"]) == 30 and got.count(["2"]) == 1
    single = systems.assigned(spark.createDataFrame([("other", "1", "7")], "collection string, id string, systemId string"), *given(spark, [("5", None), ("5", "1"), (None, "2")]))
    assert [(r.rule, r.systems, r.state) for r in single.collect()] == [("single", ["5"], "assigned")]
    assert systems.assigned(fields.limit(0), *given(spark)).collect() == []
    none = systems.assigned(fields, *given(spark, [])).collect()
    assert len(none) == 31 and {r.state for r in none} == {"unassigned"}


def test_pairs_of_names(spark):
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9])))
    left, right = [(i, name()) for i in range(60)], [(i, name()) for i in range(60)] + [(99, None), (98, "ab" * 40)]
    how = lambda a, b: "exact" if a == b else "prefix" if a.startswith(b) or b.startswith(a) else "contains" if a in b or b in a else None
    want = sorted((i, j, h) for i, a in left for j, b in right if a and b and (h := how(a, b)))
    frames = spark.createDataFrame(left, "id int, n string"), spark.createDataFrame(right, "id int, n string")
    assert sorted(tuple(r) for r in match.pair_by_name(*frames, "n", "id").collect()) == want and len(want) > 300
    declared = spark.createDataFrame([(0, 0), (500, 1)], "left_id int, right_id int")
    got = {(r.left_id, r.right_id): r.how for r in match.pair_by_name(*frames, "n", "id", declared).collect()}
    assert got[0, 0] == got[500, 1] == "declared" and len(got) == len({(i, j) for i, j, _ in want} | {(0, 0), (500, 1)})


def test_numbers_of_evidence(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["A", "B", None]), rng.choice("xyz"), str(rng.randrange(40)), None if i % 9 else "l", i) for i in range(500)]
    got = evidence.ledger(spark.createDataFrame(rows, "prefix string, source string, detail string, locator string, pos int").repartition(6), "pos").collect()
    seen = {}
    for p, s, d, l, i in rows:
        seen.setdefault(p, {}).setdefault((s, d, l), i)
    want = {(p, *k): n for p, of in seen.items() for n, k in enumerate(sorted(of, key=of.get), 1)}
    assert len(got) == len(want)
    for r in got:
        n = want[r.prefix, r.source, r.detail, r.locator]
        assert r.evidence_id == (None if r.prefix is None else f"EVID-{r.prefix}-{n:06d}")
