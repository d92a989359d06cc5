"""The report model: each rule with a case that breaks it."""

from datetime import datetime

import pytest

from marlstone.catalog import Catalog, Entity, Relation
from marlstone.errors import SpecError, UnsupportedSemantics
from marlstone.functions.dates import RUNTIME_DATES, date_range
from marlstone.functions.selectors import Selector, parse, stable_key
from marlstone.plans.compile import compile_report, count_rows
from marlstone.plans.conditions import OPERATORS, Bindings, canonical, findings
from marlstone.plans.customsql import screened
from marlstone.plans.spec import load, validate


@pytest.fixture(scope="module")
def catalog(spark):
    tables = {
        "node": spark.createDataFrame([(1, None, "root", False), (2, 1, "a", False), (3, 2, "b", True), (4, 5, "x", False), (5, 4, "y", False)], "id long, parent long, name string, gone boolean"),
        "item": spark.createDataFrame([(1, 1, "One", 2.5), (2, 1, None, 1.0), (3, 2, "tWo", None), (4, None, "%", 4.0)], "id long, node long, label string, v double"),
    }
    return Catalog(lambda n: tables[n], [Entity("node", "id", deleted="gone"), Entity("item", "id", frozenset({"v"}), captions={"V": "v", "Id": "id", "Node": "node"})], [Relation("node", "item", "node", "node", "id"), Relation("items", "node", "id", "item", "node", many=True)])


def ids(df):
    return sorted(r[0] for r in df.collect())


def where(catalog, condition, **bind):
    return ids(compile_report(catalog, {"entity": "item", "columns": [{"field": "id", "alias": "id"}], "condition": condition}, Bindings(**bind)))


def test_conditions(catalog):
    leaf = lambda op, v=None, f="label", **k: {"field": f, "operator": op, "value": v, **k}
    assert where(catalog, leaf("contains", "%")) == [4]
    assert where(catalog, leaf("equal", "two", ignoreCase=True)) == [3]
    assert where(catalog, leaf("notEqual", "One")) == [3, 4]  # NULL selects nothing
    assert where(catalog, {"all": []}) == [1, 2, 3, 4] and where(catalog, {"any": []}) == []
    assert where(catalog, leaf("equal", None, nullBehavior="checkNullValue")) == [2]
    assert where(catalog, leaf("equal", None, nullBehavior="ignoreCondition")) == [1, 2, 3, 4]
    assert where(catalog, leaf("equal", None)) == []
    assert where(catalog, leaf("inList", ["One", None])) == [1] and where(catalog, leaf("notInList", ["One", None])) == [3, 4]
    assert where(catalog, leaf("inList", [])) == [] and where(catalog, leaf("notInList", [])) == [1, 2, 3, 4]
    assert where(catalog, {"field": "label", "operator": "equal", "parameter": "p"}, values={"p": "One"}) == [1]
    for bad in (leaf("Equals", 1), leaf("between", [1]), {"field": "label", "operator": "equal", "parameter": "q"}, {"all": 3}, {"all": [], "any": []}, leaf("equal", 1, f="nothing"), {"operator": "equal", "value": 1}, leaf("equal", 1, extra=2)):
        with pytest.raises(SpecError):
            where(catalog, bad)
    for unknown in (leaf("advancedTextSearch", "x"), leaf("contains", 1, f="v"), leaf("equal", 1, dateComparisonMode="x"), leaf("equal", 1, customCode="x")):
        with pytest.raises(UnsupportedSemantics):
            where(catalog, unknown)
    assert len(OPERATORS) == 18 and len(RUNTIME_DATES) == 13


def test_canonical():
    leaf = {"field": {"path": ["a", "b"]}, "operator": "equal", "value": 1}
    assert canonical({"all": [{"any": [leaf]}, {**leaf, "enabled": False}]}) == {"field": {"items": ["a", "b"]}, "operator": "equal", "value": 1}
    assert findings(leaf) == [] and findings("x")


def test_null_keys_and_lists(catalog):
    spec = {"entity": "node", "columns": [{"field": {"self": True}, "alias": "id"}], "condition": {"all": [{"field": "id", "operator": "notInList", "value": {"report": {"entity": "item", "columns": [{"field": "node", "alias": "n"}]}}}]}}
    assert ids(compile_report(catalog, spec)) == [4, 5]  # 3 is deleted; the NULL in the list excludes nothing


def test_deleted(catalog):
    spec = {"entity": "node", "columns": [{"field": "id", "alias": "id"}]}
    assert ids(compile_report(catalog, spec)) == [1, 2, 4, 5]
    assert ids(compile_report(catalog, {**spec, "includeDeleted": True})) == [1, 2, 3, 4, 5]


def test_details_do_not_multiply(catalog):
    spec = {"entity": "node", "columns": [{"field": "id", "alias": "id"}, {"alias": "n", "detail": {"relation": "items", "aggregate": "count", "field": "id"}}, {"alias": "s", "detail": {"relation": "items", "aggregate": "sum", "field": "v"}}]}
    assert sorted(map(tuple, compile_report(catalog, spec).collect())) == [(1, 2, 3.5), (2, 1, None), (4, 0, None), (5, 0, None)]
    with pytest.raises(SpecError):
        compile_report(catalog, {"entity": "item", "columns": [{"alias": "n", "detail": {"relation": "node", "aggregate": "count"}}]})


def test_tree(catalog):
    spec = {"entity": "node", "columns": [{"field": "name", "alias": "name"}], "selfReferencingField": "parent"}
    assert sorted((r.name, r.level) for r in compile_report(catalog, {**spec, "includeDeleted": True}).collect()) == [("a", 1), ("b", 2), ("root", 0)]
    assert sorted((r.name, r.level) for r in compile_report(catalog, spec).collect()) == [("a", 1), ("root", 0)]  # b is deleted
    assert sorted(r.name for r in compile_report(catalog, {**spec, "treeAutoOpenLevels": 1}).collect()) == ["a", "root"]


def test_clauses(catalog):
    base = {"entity": "item", "columns": [{"field": "id", "alias": "id"}, {"field": "v", "alias": "v"}]}
    rows = lambda **k: [tuple(r) for r in compile_report(catalog, {**base, **k}).collect()]
    assert rows(sorting=[{"alias": "id", "direction": "desc"}], top=1) == [(4, 4.0)]
    assert rows(sorting=[{"alias": "id"}], pageSize=2, pageIndex=1) == [(3, None), (4, 4.0)]
    assert sorted(r[2] for r in rows(sorting=[{"alias": "id", "direction": "desc"}], showRowNumber=True)) == [1, 2, 3, 4]
    assert count_rows(catalog, {**base, "pageSize": 1}) == 4 and count_rows(catalog, {**base, "dontExecuteCount": True}) is None
    assert compile_report(catalog, {"entity": "item", "columns": [{"field": "id"}, {"field": "v", "alias": "a"}, {"field": "v", "alias": "a"}]}).columns == ["~0", "a", "~2"]
    got = compile_report(catalog, {"entity": "item", "columns": [{"formula": "-({V} + 1) * 2 / {Id}", "alias": "f"}], "condition": {"field": "id", "operator": "equal", "value": 1}}).first()
    assert got.f == -7.0
    for bad in ({"formula": "{V"}, {"formula": "{W}"}, {"formula": "{V} {V}"}, {"formula": "{V} +"}, {"formula": "({V}"}):
        with pytest.raises(SpecError):
            compile_report(catalog, {"entity": "item", "columns": [{**bad, "alias": "f"}]})


def test_validation():
    ok = {"entity": "item", "columns": [{"field": "id", "alias": "id"}]}
    assert validate(ok) == []
    for bad in ({"entity": None}, {"oracleHint": "x"}, {"mystery": 1}, {"sorting": [{"alias": "id", "direction": "up"}]}, {"top": -1}, {"parameters": [{"name": "a"}, {"name": "a"}]}, {"sqlGrouping": ["x"]}, {"columns": [{"alias": "a"}]}, {"columns": [{"field": "id", "aggregate": "median"}]}):
        with pytest.raises(SpecError):
            load({**ok, **bad})
    assert load("\ufeff" + '{"entity": "#item", "columns": []}').entity == "item"


def test_custom_sql():
    at = datetime(2024, 1, 15)
    assert screened("DATEADD(day, -7, GETDATE())", at) == "timestampadd(DAY, -7, TIMESTAMP '2024-01-15 00:00:00')"
    assert screened("a = 'drop table; --'") == "a = 'drop table; --'"
    for bad in ("1; drop table x", "x in (select 1)", "java_method('a')", "a -- b", "xp_run(1)", "DATEADD(eon, 1, a)", "GETDATE() > a"):
        with pytest.raises(UnsupportedSemantics):
            screened(bad)


def test_dates():
    at = datetime(2024, 1, 31, 23, 59)
    assert date_range("nextMonth", at) == (datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert date_range("previousMonth", at) == (datetime(2023, 12, 1), datetime(2024, 1, 1))
    assert date_range("thisWeek", at) == (datetime(2024, 1, 29), datetime(2024, 2, 5))
    assert date_range("thisWeek", at, 5) == (datetime(2024, 1, 27), datetime(2024, 2, 3))
    assert date_range("tomorrow", at)[0] == datetime(2024, 2, 1) and date_range("previousYear", at)[0].year == 2023
    with pytest.raises(SpecError):
        date_range("someday", at)


def test_selectors():
    for s in (Selector(("a|b", "c]#"), "T"), Selector(("x",)), Selector(("a\\", "b/"))):
        assert parse(str(s)) == s
    for bad in ("x", "#", "#a\\q", "#[T]"):
        with pytest.raises(SpecError):
            parse(bad)
    key = stable_key("name")
    assert len(key) == 7 and len(stable_key("name", {key})) == 8


def test_tree_takes_the_condition(catalog):
    spec = {"entity": "node", "columns": [{"field": "name", "alias": "name"}], "selfReferencingField": "parent"}
    names = lambda more: sorted((r.name, r.level) for r in compile_report(catalog, {**spec, **more}).collect())
    whole = names({})
    is_a = {"field": "name", "operator": "equal", "value": "a"}
    assert names({"condition": is_a}) == [x for x in whole if x[0] == "a"]
    assert names({"additionalWhere": "name <> 'a'"}) == [x for x in whole if x[0] != "a"]
    # a row that treeCondition rules out ends its branch
    assert names({"treeCondition": {"field": "name", "operator": "equal", "value": "root"}}) == [("root", 0)]
    assert ("a", 0) in names({"treeCondition": is_a, "useHierarchyConditionForRoot": True})
    with pytest.raises(UnsupportedSemantics):
        names({"isDistinct": True})


@pytest.mark.parametrize("kind", ["gantt", "form", "dashboard", "print"])
def test_kinds_without_rows(catalog, kind):
    with pytest.raises(UnsupportedSemantics):
        compile_report(catalog, {"entity": "node", "columns": [{"field": "name", "alias": "name"}], "reportType": kind})


def test_aliases_and_parents_are_checked(catalog):
    spec = {"entity": "node", "columns": [{"field": "name", "alias": "name"}]}
    with pytest.raises(SpecError):
        compile_report(catalog, {**spec, "joinAliases": [{"name": "x", "field": "parent"}, {"name": "x", "field": "parent"}]})
    with pytest.raises(SpecError):
        compile_report(catalog, {**spec, "parameters": [{"name": "Id", "external": True}], "condition": {"field": "name", "operator": "equal", "parameter": "Id"}})
