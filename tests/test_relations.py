"""Access rules that nothing escapes, and totals over paths that multiply no rows."""

import re

import pytest

from marlstone.catalog import Catalog, Entity, Relation
from marlstone.errors import SpecError
from marlstone.plans.compile import compile_report, count_rows
from marlstone.plans.conditions import Bindings

OWNERS = [(1, "a", None), (2, "b", 1), (3, "hidden", 1), (None, "no id", None)]
THINGS = [(10, 1, 5, None), (11, 1, 7, 10), (12, 3, 9, 10), (13, None, 11, 12), (14, 2, None, 13), (15, 99, 1, 10)]
PARTS = [(100, 10, 1.5), (101, 10, 2.5), (102, 12, 4.0), (103, 14, 8.0), (104, None, 16.0)]


@pytest.fixture(scope="module")
def catalog(spark):
    data = {
        "owner": spark.createDataFrame(OWNERS, "oid long, name string, boss long"),
        "thing": spark.createDataFrame(THINGS, "tid long, owner_id long, size long, up long"),
        "part": spark.createDataFrame(PARTS, "pid long, thing_id long, cost double"),
    }
    relations = [
        Relation("owner", "thing", "owner_id", "owner", "oid"), Relation("things", "owner", "oid", "thing", "owner_id", many=True), Relation("thing", "part", "thing_id", "thing", "tid"),
        Relation("parts", "thing", "tid", "part", "thing_id", many=True), Relation("boss", "owner", "boss", "owner", "oid"), Relation("up", "thing", "up", "thing", "tid"),
    ]
    return Catalog(lambda n: data[n], [Entity("owner", "oid"), Entity("thing", "tid"), Entity("part", "pid", frozenset({"cost"}))], relations)


RULE = {"owner": {"condition": {"field": "name", "operator": "notEqual", "value": "hidden"}}}
BIND = Bindings(access=RULE)


def got(catalog, report, bind=BIND):
    return sorted((tuple(r) for r in compile_report(catalog, report, bind).collect()), key=str)


def field(*items):
    return {"items": list(items)}


NAME = [{"field": "name", "alias": "name"}]
PART_OWNER = {"entity": "part", "columns": [{"field": "pid", "alias": "pid"}, {"field": field("thing", "owner", "name"), "alias": "owner"}]}


def test_every_instance_is_restricted(catalog):
    assert got(catalog, {"entity": "owner", "columns": NAME}) == [("a",), ("b",), ("no id",)]
    assert got(catalog, PART_OWNER) == [(100, "a"), (101, "a"), (102, None), (103, "b"), (104, None)]
    alias = {"entity": "part", "joinAliases": [{"name": "o", "field": field("thing", "owner")}], "columns": [{"field": field("o", "name"), "alias": "n"}]}
    assert ("hidden",) not in got(catalog, alias)
    detail = {"entity": "thing", "columns": [{"field": "tid", "alias": "t"}, {"detail": {"relation": "parts", "aggregate": "count", "condition": {"field": field("thing", "owner", "name"), "operator": "isNotNull"}}, "alias": "n"}]}
    assert dict(got(catalog, detail))[12] == 0 and dict(got(catalog, detail))[10] == 2
    listed = {"entity": "thing", "columns": [{"field": "tid", "alias": "t"}], "condition": {"any": [{"field": "owner_id", "operator": "inList", "value": {"report": {"entity": "owner", "columns": [{"field": "oid", "alias": "o"}]}}}]}}
    assert got(catalog, listed) == [(10,), (11,), (14,)]
    union = {"entity": "thing", "columns": [{"field": "tid", "alias": "x"}], "condition": {"any": []}, "subReports": [{"entity": "owner", "columns": [{"field": "oid", "alias": "x"}]}]}
    assert got(catalog, union) == [(1,), (2,), (None,)]
    tree = {"entity": "owner", "selfReferencingField": "boss", "columns": NAME}
    assert {r[0] for r in got(catalog, tree)} == {"a", "b"}
    matrix = {"entity": "thing", "columns": [], "matrix": {"vertical": field("owner", "name"), "horizontal": "up", "value": "size", "aggregate": "sum", "values": [10]}}
    assert "hidden" not in {r[0] for r in got(catalog, matrix)}
    assert count_rows(catalog, {"entity": "owner", "columns": NAME}, BIND) == 3
    grouped = {"entity": "thing", "columns": [{"field": field("owner", "name"), "alias": "o"}, {"aggregate": "count", "alias": "n"}], "sqlGrouping": ["o"]}
    assert got(catalog, grouped) == [("a", 2), ("b", 1), (None, 3)]


def test_no_rules_no_change(catalog):
    assert got(catalog, PART_OWNER, Bindings()) == got(catalog, PART_OWNER, Bindings(access={})) == [(100, "a"), (101, "a"), (102, "hidden"), (103, "b"), (104, None)]


def test_through(catalog):
    bind = Bindings(access={**RULE, "thing": {"through": ["owner"], "condition": {"field": "size", "operator": "lessThan", "parameter": "most"}}, "part": {"through": ["thing"]}}, values={"most": 8})
    assert got(catalog, {"entity": "part", "columns": [{"field": "pid", "alias": "p"}]}, bind) == [(100,), (101,)]
    assert got(catalog, {"entity": "thing", "columns": [{"field": "tid", "alias": "t"}]}, bind) == [(10,), (11,)]
    assert got(catalog, {"entity": "owner", "columns": [*NAME, {"detail": {"path": ["things", "parts"], "field": "cost", "aggregate": "sum"}, "alias": "c"}]}, bind) == [("a", 4.0), ("b", None), ("no id", None)]


def test_rules_by_path_and_user(catalog):
    bind = Bindings(access={"thing": {"condition": {"field": field("owner", "boss", "name"), "operator": "equal", "parameter": "me"}}, **RULE}, values={"me": "a"})
    # the rule of thing sees the hidden owner, the report doesn't
    assert got(catalog, {"entity": "thing", "columns": [{"field": "tid", "alias": "t"}, {"field": field("owner", "name"), "alias": "o"}]}, bind) == [(12, None), (14, "b")]


def test_rules_can_be_ignored_only_where_allowed(catalog):
    open_ = {"entity": "owner", "columns": NAME, "ignoreAdvancedSecurityCondition": True}
    for report in (open_, {"entity": "owner", "columns": NAME, "useAdvancedAccess": False}, {"entity": "thing", "columns": [{"field": "tid", "alias": "name"}], "subReports": [open_]}):
        with pytest.raises(SpecError, match="doesn't allow"):
            got(catalog, report)
    assert ("hidden",) in got(catalog, open_, Bindings(access=RULE, may_ignore_access=True))
    mixed = {"entity": "owner", "columns": NAME, "subReports": [{**open_, "subReports": [{"entity": "owner", "columns": NAME}]}]}
    assert [r[0] for r in got(catalog, mixed, Bindings(access=RULE, may_ignore_access=True))].count("hidden") == 1
    assert ("hidden",) in got(catalog, open_, Bindings())


@pytest.mark.parametrize(
    ("rules", "message"),
    [
        ({"owner": {"conditions": {}}}, "unknown conditions"), ({"nothing": {}}, "unknown entity"), ({"owner": {"through": ["things"]}}, "no relation to one row"), ({"owner": {"through": ["x"]}}, "no relation to one row"),
        ({"owner": {"through": ["boss"]}}, "lead back to owner"), ({"owner": {"condition": {"field": field("things", "size"), "operator": "equal", "value": 5}}}, "relation to many"), ({"owner": {"condition": {"field": "name", "operator": "like", "value": 5}}}, "like"),
    ],
)
def test_wrong_rules_are_errors(catalog, rules, message):
    with pytest.raises(SpecError, match=message):
        got(catalog, {"entity": "owner", "columns": NAME}, Bindings(access=rules))


def totals(*aggregates, path=("things", "parts"), value="cost"):
    return [{"detail": {"path": list(path), "aggregate": a, **({} if a in ("count", "exists", "notExists") else {"field": value})}, "alias": a} for a in aggregates]


def test_totals_over_a_path(catalog):
    report = {"entity": "owner", "columns": [*NAME, *totals("count", "sum", "avg", "min", "max", "exists", "notExists")]}
    assert got(catalog, report, Bindings()) == [("a", 2, 4.0, 2.0, 1.5, 2.5, True, False), ("b", 1, 8.0, 8.0, 8.0, 8.0, True, False), ("hidden", 1, 4.0, 4.0, 4.0, 4.0, True, False), ("no id", 0, None, None, None, None, False, True)]
    # two paths of one row, and one through its boss: no total is counted twice
    more = [*NAME, *totals("sum"), {"detail": {"path": ["things"], "field": "size", "aggregate": "sum"}, "alias": "size"}, {"detail": {"path": ["boss", "things", "parts"], "aggregate": "count"}, "alias": "above"}]
    assert got(catalog, {"entity": "owner", "columns": more}, Bindings()) == [("a", 4.0, 12.0, 0), ("b", 8.0, None, 2), ("hidden", 4.0, 9.0, 2), ("no id", None, None, 0)]


def test_totals_are_merged_by_group(catalog):
    report = {"entity": "owner", "columns": [{"field": "boss", "alias": "boss"}, {"aggregate": "count", "alias": "n"}, *totals("avg", "notExists")], "sqlGrouping": ["boss"], "useSummaryRow": True}
    assert got(catalog, report, Bindings()) == sorted([(1, 2, 6.0, False, False), (None, 2, 2.0, False, False), (None, 4, 4.0, False, True)], key=str)


def test_one_aggregate_below_each_join(catalog):
    df = compile_report(catalog, {"entity": "owner", "columns": [*NAME, *totals("sum")]}, Bindings())
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda x: len(re.match(r"[ :+\-|]*", x)[0])
    joins = [depth(x) for x in lines if "Join" in x]
    aggregates = [depth(x) for x in lines if "Aggregate" in x]
    assert len(joins) == len(aggregates) == 2 and joins[0] < aggregates[0] < joins[1] < aggregates[1]


@pytest.mark.parametrize(
    "detail",
    [
        {"path": ["things"], "aggregate": "first", "field": "size"}, {"path": [], "aggregate": "count"}, {"path": ["x"], "aggregate": "count"}, {"path": ["things"], "aggregate": "sum", "field": field("parts", "cost")},
        {"path": ["things"], "aggregate": "count", "excludeSelf": True}, {"path": ["things"], "aggregate": "sum", "field": "gone"},
    ],
)
def test_wrong_paths_are_errors(catalog, detail):
    with pytest.raises(SpecError):
        got(catalog, {"entity": "owner", "columns": [{"detail": detail, "alias": "x"}]}, Bindings())
