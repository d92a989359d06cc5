"""Applying batches: cycles of references are closed, failures leave their dependants unresolved and listed, ids have no gaps."""

import random

from marlstone.operators import apply

COMMANDS = "batch_id long, pos int, objectType string, tempId string"
REFERENCES = "batch_id long, pos int, field string, tempId string, structural boolean"


def applied(spark, commands, references, refused=(), after=None):
    c, r = spark.createDataFrame(commands, COMMANDS), spark.createDataFrame(references, REFERENCES)
    objects = apply.create(c, r, spark.createDataFrame(list(refused), "batch_id long, pos int"), 100)
    order = spark.createDataFrame(after, "objectType string, field string, needs string") if after is not None else None
    return objects, apply.ledger(objects, c, r, order)


def state(objects):
    return {(r.batch_id, r.pos): (r.id, r.status) for r in objects.collect()}


def completed(led):
    return {(r.batch_id, r.pos, r.field): (r.placeholder, r.value, r.state) for r in led.collect()}


def test_two_rows_that_refer_to_each_other(spark):
    commands = [(1, 1, "report", "a"), (1, 2, "report", "b"), (1, 3, "dynamicObject", None), (2, 1, "field", "a")]
    references = [(1, 1, "folder", "b", False), (1, 2, "folder", "a", False), (1, 3, "self", "a", False), (2, 1, "x", "b", False)]
    objects, led = applied(spark, commands, references)
    assert state(objects) == {(1, 1): (100, "created"), (1, 2): (101, "created"), (2, 1): (102, "created"), (1, 3): (103, "created")}
    assert completed(led) == {(1, 1, "folder"): (-1, 101, "resolved"), (1, 2, "folder"): (-1, 100, "resolved"), (1, 3, "self"): (-1, 100, "resolved"), (2, 1, "x"): (-1, None, "missing")}
    written = spark.createDataFrame([(1, 1, "folder", -1), (1, 2, "folder", -1), (2, 1, "x", -1), (1, 3, "self", 7)], "batch_id long, pos int, field string, reference long")
    assert sorted((r.batch_id, r.pos, r.reference) for r in apply.filled(written, led).collect()) == [(1, 1, 101), (1, 2, 100), (1, 3, 7), (2, 1, -1)]


def test_failures_are_listed(spark):
    commands = [(1, i, "field", f"t{i}") for i in range(1, 9)]
    references = [(1, 2, "target", "t1", True), (1, 3, "target", "t2", True), (1, 4, "view", "t2", False), (1, 5, "target", "none", True), (1, 6, "target", "t7", True), (1, 7, "target", "t6", True), (1, 8, "target", "t4", True), (1, 2, "view", "t4", False)]
    objects, led = applied(spark, commands, references, [(1, 1)])
    assert state(objects) == {(1, 1): (None, "refused"), (1, 2): (None, "dependency"), (1, 3): (None, "dependency"), (1, 4): (100, "created"), (1, 5): (None, "missing_target"), (1, 6): (None, "cycle"), (1, 7): (None, "cycle"), (1, 8): (101, "created")}
    assert completed(led) == {(1, 4, "view"): (-1, None, "unresolved"), (1, 2, "view"): (None, None, "no_row")}


def test_steps_do_not_depend_on_the_text(spark):
    commands = [(1, 1, "report", "a")]
    references = [(1, 1, f, "a", False) for f in ("condition", "parameters", "sorting", "columns", "p", "q", "free")]
    after = [("report", "condition", "parameters"), ("report", "sorting", "columns"), ("report", "parameters", "columns"), ("report", "p", "q"), ("report", "q", "p"), ("other", "free", "x")]
    _, led = applied(spark, commands, references, after=after)
    assert {r.field: (r.step, r.ordered) for r in led.collect()} == {"columns": (0, True), "free": (0, True), "parameters": (1, True), "sorting": (1, True), "condition": (2, True), "p": (3, False), "q": (3, False)}


def test_against_a_walk(spark):
    rng = random.Random(3)
    commands, references, refused = [], [], []
    for b in range(12):
        n = rng.randrange(1, 15)
        commands += [(b, i, rng.choice(["field", "dynamicObject"]), f"t{i}") for i in range(n)]
        references += [(b, i, "up", f"t{rng.randrange(n + 1)}", True) for i in range(n) if rng.random() < 0.5]
        references += [(b, i, "to", f"t{rng.randrange(n + 1)}", False) for i in range(n)]
        refused += [(b, i) for i in range(n) if rng.random() < 0.1]
    objects, led = applied(spark, commands, references, refused)
    there = {(b, t): i for b, i, _, t in commands}
    up = {(b, i): there.get((b, t), -1) for b, i, _, t, s in references if s}

    def fine(b, i):
        seen = set()
        while i is not None:
            if i in seen or (b, i) in refused or i == -1:
                return False
            seen.add(i)
            i = up.get((b, i))
        return True

    got = state(objects)
    assert {k for k, (i, _) in got.items() if i is not None} == {(b, i) for b, i, *_ in commands if fine(b, i)}
    ids = sorted(i for i, _ in got.values() if i is not None)
    assert ids == list(range(100, 100 + len(ids)))
    order = sorted((i, 2 if kind == "dynamicObject" else 1) for (b, p, kind, _) in commands if (i := got[b, p][0]) is not None)
    assert [p for _, p in order] == sorted(p for _, p in order)
    for (b, i, _), (_, value, what) in completed(led).items():
        t = next(t for rb, ri, f, t, s in references if (rb, ri, f) == (b, i, "to"))
        target = there.get((b, t))
        want = "no_row" if got[b, i][0] is None else "missing" if target is None else "unresolved" if got[b, target][0] is None else "resolved"
        assert what == want and value == (got[b, target][0] if want == "resolved" else None)


def test_nothing(spark):
    objects, led = applied(spark, [], [])
    assert objects.collect() == [] and led.collect() == []


def test_lines_of_commands_are_worked_out_once(spark):
    from marlstone import queries_changes

    for t in queries_changes._lines(spark, "/root/testdata/sf0.001"):
        plan = t._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "Window" not in plan
