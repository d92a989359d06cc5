"""Interval labels, descendants and totals of forests against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.errors import SpecError
from marlstone.operators import forest, ranges


def frame(spark, parents):
    return spark.createDataFrame(list(parents.items()), "id long, parent long")


def walked(parents):
    """({id: (parent, root, depth, first, last)}, cyclic ids) by recursion without a stack limit."""
    children, out, at = {}, {}, 0
    for i, p in parents.items():
        children.setdefault(p if p in parents else None, []).append(i)
    stack = [(i, None, i, 0) for i in sorted(children.get(None, []), reverse=True)]
    order = []
    while stack:
        i, p, root, depth = stack.pop()
        order.append(i)
        out[i] = [p, root, depth, at, at]
        at += 1
        stack += [(c, i, root, depth + 1) for c in sorted(children.get(i, []), reverse=True)]
    for i in reversed(order):
        if out[i][0] is not None:
            out[out[i][0]][4] = max(out[out[i][0]][4], out[i][4])
    return {i: tuple(v) for i, v in out.items()}, sorted(set(parents) - set(out))


def check(spark, parents):
    got, cyclic = forest.labels(frame(spark, parents))
    want, on_cycles = walked(parents)
    assert {r.id: (r.parent, r.root, r.depth, r.first, r.last) for r in got.collect()} == want
    assert sorted(r.id for r in cyclic.collect()) == on_cycles
    return got, want


def test_random_forests(spark):
    rng = random.Random(6)
    ids = rng.sample(range(1000), 200)
    parents = {i: rng.choice([None, *ids[:k], 5000 + k]) if k else None for k, i in enumerate(ids)}
    got, want = check(spark, parents)
    of = [ids[3], ids[50], ids[199], 77777]
    below = {(a, i, want[i][2] - want[a][2]) for a in of[:3] for i in want if want[a][3] < want[i][3] <= want[a][4]}
    for width in (1, 7, 4096):
        assert {tuple(r) for r in forest.descendants(got, spark.createDataFrame([(i,) for i in of + of], "id long"), width=width).collect()} == below
    assert {tuple(r) for r in forest.descendants(got, spark.createDataFrame([(i,) for i in of], "id long"), itself=True).collect()} == below | {(a, a, 0) for a in of[:3]}
    values = [(i, rng.randrange(-5, 50)) for i in ids for _ in range(rng.randrange(3))] + [(88888, 1), (None, 1), (ids[0], None)]
    own = {}
    for i, v in values:
        own[i] = own.get(i, 0) + (v or 0)
    totals = {i: (sum(own.get(x, 0) for x in want if w[3] <= want[x][3] <= w[4]), w[4] - w[3] + 1) for i, w in want.items()}
    assert {r.id: (r.total, r["rows"]) for r in forest.subtree_totals(got, spark.createDataFrame(values, "node long, v int"), "node", "v").collect()} == totals


def test_a_chain_of_a_thousand(spark):
    check(spark, {i: i - 1 if i else None for i in range(1000)})


def test_cycles_and_what_hangs_on_them(spark):
    check(spark, {1: None, 2: 1, 3: 4, 4: 5, 5: 3, 6: 5, 7: 6, 8: 8, 9: 8, 10: 99})


def test_one_parent_with_most_rows(spark):
    check(spark, {0: None, **{i: 0 for i in range(1, 600)}, **{1000 + i: i for i in range(1, 50)}})


def test_none_and_wrong_ids(spark):
    check(spark, {})
    check(spark, {1: None})
    for rows in ([(1, None), (1, None)], [(None, 1)]):
        with pytest.raises(SpecError, match="unique ids"):
            forest.labels(spark.createDataFrame(rows, "id long, parent long"))


def test_forest_of_entities(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k long, t string"), spark.createDataFrame([("p", 1), ("q", None), ("r", 9)], "k string, up long")
    nodes = forest.forest([("a", a, "k", None, None), ("b", b, "k", "a", "up")])
    assert sorted(tuple(r) for r in nodes.na.fill("-").collect()) == [("a:1", "-", "a"), ("a:2", "-", "a"), ("b:p", "a:1", "b"), ("b:q", "-", "b"), ("b:r", "a:9", "b")]
    got, _ = forest.labels(nodes)
    assert [(r.id, r.root) for r in got.orderBy("first").collect()] == [("a:1", "a:1"), ("b:p", "a:1"), ("a:2", "a:2"), ("b:q", "b:q"), ("b:r", "b:r")]


def test_running_totals(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("k"), "id")
    got = ranges.totalled(df.repartition(5), ["k", "id"], F.col("id"), "before").collect()
    total = 0
    for r in sorted(got, key=lambda r: (r.k, r.id)):
        assert r.before == total
        total += r.id
    assert sorted(r.at for r in ranges.numbered(df, [F.desc("k")], "at").collect()) == list(range(500))
    assert ranges.numbered(df.limit(0), ["k"], "at").collect() == []


def test_leaves_take_no_part_in_the_rounds(spark, monkeypatch):
    written = []
    for module in (forest, ranges):
        stored = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name, stored=stored: (t := stored(df, name), written.append(t.count()))[0])
    parents = {i: None if i < 10 else i % 10 if i < 100 else 10 + i % 90 for i in range(2000)}
    got, _ = forest.labels(frame(spark, parents))
    want, _ = walked(parents)
    assert {r.id: (r.parent, r.root, r.depth, r.first, r.last) for r in got.collect()} == want
    # all rows are written a few times, however many rounds there are
    assert sum(written) < 5 * len(parents)
