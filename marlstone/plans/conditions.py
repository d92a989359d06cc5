"""Condition trees as column predicates.

A node is a leaf, {"all": [...]} or {"any": [...]}; an empty list under all holds for every row, under any for none.
NULL follows SQL: a comparison with NULL selects nothing, negated or not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SpecError, UnsupportedSemantics
from ..functions.dates import RUNTIME_DATES, date_range

#: The comparison operators, null behaviours and keys of a clause.
OPERATORS = (
    "none", "equal", "notEqual", "greaterThan", "lessThan", "greaterThanOrEqual", "lessThanOrEqual", "contains", "doesNotContain",
    "startsWith", "doesNotStartWith", "isNull", "isNotNull", "between", "inList", "notInList", "advancedTextSearch", "advancedTextSearch2",
)
NULL_BEHAVIORS = ("ignoreCondition", "checkNullValue", "dontIgnore")
CLAUSE_KEYS = frozenset(
    {
        "field", "operator", "value", "parameter", "enabled", "ignoreCase", "nullBehavior", "valueType", "type", "dateComparisonMode", "customSql",
        "customCode", "customCodeExecutePerRow", "autoSetInNew", "predefinedConditionId", "serviceAccessConditionId", "entity", "valueField",
    }
)


@dataclass
class Bindings:
    """What a run supplies: parameter values, the moment and the user that runtime parameters mean."""

    values: dict[str, Any] = field(default_factory=dict)
    as_of: datetime | None = None
    current_user: Any = None
    week_starts: int = 0
    allow_text_search: bool = False
    #: The object that a report is opened from: its Id and its fields by caption, for external parameters.
    parent: dict[str, Any] | None = None
    #: Rules of row-level access by entity (see access.py), and whether a report may ask to be read without them.
    access: dict[str, dict[str, Any]] | None = None
    may_ignore_access: bool = False

    def runtime(self, kind: str) -> Any:
        if kind == "currentUser":
            return self.current_user
        if kind in RUNTIME_DATES:
            if self.as_of is None:
                raise SpecError(f"{kind} needs as_of")
            return DateRange(*date_range(kind, self.as_of, self.week_starts))
        raise SpecError(f"unknown context value {kind}")


@dataclass(frozen=True)
class DateRange:
    start: datetime
    end: datetime


Resolve = Callable[[Any], Column]


def is_leaf(node: dict) -> bool:
    return "all" not in node and "any" not in node


def findings(node: Any, where: str = "condition") -> list[tuple[str, str]]:
    """(place, message) for all that is wrong with a tree, without running it."""
    if not isinstance(node, dict):
        return [(where, "a condition is an object")]
    if not is_leaf(node):
        kind = "all" if "all" in node else "any"
        out = [(where, f"{k} beside {kind}") for k in node if k != kind and not k.startswith("_")]
        if not isinstance(node[kind], list):
            return [*out, (where, f"{kind} must be a list")]
        return out + [f for i, x in enumerate(node[kind]) for f in findings(x, f"{where}.{kind}[{i}]")]
    out = [(where, f"unknown key {k}") for k in sorted(node) if k not in CLAUSE_KEYS]
    op = node.get("operator")
    if op not in OPERATORS:
        out.append((where, f"unknown operator {op}"))
    if "field" not in node and op != "none" and "customSql" not in node:
        out.append((where, "a clause needs a field"))
    if node.get("nullBehavior") not in (None, *NULL_BEHAVIORS):
        out.append((where, f"unknown nullBehavior {node['nullBehavior']}"))
    if op not in (None, "none", "isNull", "isNotNull") and not {"value", "parameter", "valueField", "customSql"} & node.keys():
        out.append((where, "a comparison needs a value or a parameter"))
    return out


def canonical(node: dict) -> dict:
    """The tree with disabled clauses dropped, single-child groups collapsed, and paths under items."""
    if is_leaf(node):
        out = {k: v for k, v in node.items() if k not in ("enabled", "type", "valueType")}
        if isinstance(out.get("field"), dict) and "path" in out["field"]:
            out["field"] = {"items": out["field"]["path"]}
        return out
    kind = "all" if "all" in node else "any"
    kids = [canonical(x) for x in node[kind] if x.get("enabled", True)]
    return kids[0] if len(kids) == 1 else {kind: kids}


def predicate(node: dict, resolve: Resolve, bind: Bindings, type_of: Callable[[Any], T.DataType | None] = lambda f: None) -> Column:
    """The tree as one boolean column. resolve gives the column of a field, type_of its type if known."""
    if wrong := findings(node):
        raise SpecError("; ".join(f"{a}: {b}" for a, b in wrong))
    return _node(node, resolve, bind, type_of)


def _node(node: dict, resolve: Resolve, bind: Bindings, type_of) -> Column:
    if is_leaf(node):
        return _leaf(node, resolve, bind, type_of)
    parts = [_node(x, resolve, bind, type_of) for x in node.get("all", node.get("any"))]
    if "all" in node:
        return reduce(lambda a, b: a & b, parts, F.lit(True)) if len(parts) != 1 else parts[0]
    return reduce(lambda a, b: a | b, parts, F.lit(False)) if len(parts) != 1 else parts[0]


def _value(node: dict, bind: Bindings) -> Any:
    if "parameter" in node:
        name = node["parameter"]
        if name not in bind.values:
            raise SpecError(f"parameter {name} is not bound")
        return bind.values[name]
    return node.get("value")


def _leaf(node: dict, resolve: Resolve, bind: Bindings, type_of) -> Column:
    if not node.get("enabled", True):
        return F.lit(True)
    if node.get("customCode"):
        raise UnsupportedSemantics("customCode is never executed")
    if node.get("dateComparisonMode"):
        raise UnsupportedSemantics("dateComparisonMode is known by name only")
    if node.get("customSql"):
        from .customsql import screened

        return F.expr(screened(node["customSql"], bind.as_of))
    if node["operator"] == "none":
        return F.lit(True)
    op, col = node["operator"], resolve(node["field"])
    if op == "isNull":
        return col.isNull()
    if op == "isNotNull":
        return col.isNotNull()
    lower = F.lower if node.get("ignoreCase") else (lambda c: c)
    if "valueField" in node:
        return _compare(op, lower(col), lower(resolve(node["valueField"])))
    value = _value(node, bind)
    if value is None or isinstance(value, list) and all(v is None for v in value) and value:
        behave = node.get("nullBehavior", "dontIgnore")
        if behave == "ignoreCondition":
            return F.lit(True)
        if behave == "checkNullValue":
            return col.isNull()
    if op in ("contains", "doesNotContain") and not isinstance(type_of(node["field"]) or T.StringType(), T.StringType):
        raise UnsupportedSemantics(f"{op} is defined for text only")
    if isinstance(value, DateRange):
        inside = (col >= F.lit(value.start)) & (col < F.lit(value.end))
        edge = {"greaterThan": col >= F.lit(value.end), "greaterThanOrEqual": col >= F.lit(value.start), "lessThan": col < F.lit(value.start), "lessThanOrEqual": col < F.lit(value.end)}
        if value.start == value.end:
            edge |= {"greaterThan": col > F.lit(value.end), "lessThanOrEqual": col <= F.lit(value.end)}
            inside = col == F.lit(value.start)
        if op in ("equal", "between"):
            return inside
        if op == "notEqual":
            return ~inside
        if op in edge:
            return edge[op]
        raise SpecError(f"{op} does not take a date range")
    if op == "between":
        if not isinstance(value, list) or len(value) != 2:
            raise SpecError("between takes two values")
        return lower(col).between(lower(F.lit(value[0])), lower(F.lit(value[1])))
    if op in ("inList", "notInList"):
        if not isinstance(value, list):
            raise SpecError(f"{op} takes a list")
        known = [v.lower() if node.get("ignoreCase") and isinstance(v, str) else v for v in value if v is not None]
        hit = lower(col).isin(known) if known else F.lit(False)
        return hit if op == "inList" else ~hit
    if op.startswith("advancedTextSearch"):
        if not bind.allow_text_search:
            raise UnsupportedSemantics(f"{op}: its meaning is not stated; allow_text_search turns an approximation on")
        from ..functions.text import fold_match, tokens

        have, wanted = tokens(fold_match(col)), tokens(fold_match(F.lit(value)))
        return F.size(F.array_except(wanted, have)) == 0 if op == "advancedTextSearch" else F.arrays_overlap(wanted, have)
    return _compare(op, lower(col), lower(F.lit(value)))


def _compare(op: str, c: Column, v: Column) -> Column:
    plain = {
        "equal": lambda: c == v,
        "notEqual": lambda: c != v,
        "greaterThan": lambda: c > v,
        "lessThan": lambda: c < v,
        "greaterThanOrEqual": lambda: c >= v,
        "lessThanOrEqual": lambda: c <= v,
        "contains": lambda: F.contains(c, v),
        "doesNotContain": lambda: ~F.contains(c, v),
        "startsWith": lambda: F.startswith(c, v),
        "doesNotStartWith": lambda: ~F.startswith(c, v),
    }
    if op not in plain:
        raise SpecError(f"{op} does not compare two columns")
    return plain[op]()
