"""Report specifications: loading, validation and defaults."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass
from typing import Any

from ..errors import SpecError
from .conditions import findings as condition_findings

#: Aggregates of a column, report kinds, and the keys of a report.
AGGREGATES = ("count", "sum", "min", "max", "avg", "first", "stringConcat", "exists", "notExists", "custom")
KNOWN_KEYS = frozenset(
    {
        "name", "entity", "parent", "reportType", "columns", "condition", "treeCondition", "parameters", "joinAliases", "isDistinct", "top", "includeDeleted", "sorting",
        "sqlGrouping", "gridGrouping", "useSummaryRow", "matrix", "subReports", "selfReferencingField", "treeAutoOpenLevels", "useHierarchyConditionForRoot",
        "dontUseChildParentReport", "ignoreColumns", "additionalWhere", "formatConditions", "pageSize", "pageIndex", "pagingType", "dontExecuteCount", "showRowNumber",
        "calendar", "forum", "caption", "immediateExecute", "semiJoins", "useAdvancedAccess", "ignoreAdvancedSecurityCondition",
    }
)
_REFUSED = ("extraQueryTemplate", "oracleHint", "alternateRootTable", "rootTableAlias", "customCode")
_SORTS = ("asc", "desc")
#: What a calendar's or forum's rows are made of. The short names are accepted for the same.
ROLES = {
    "calendar": ("name", "description", "startDate", "endDate", "ownerId", "hasReminder", "imageType", "color", "groupColorField", "ownerReport", "start", "end", "owner"),
    "forum": ("titleField", "descriptionField", "timeField", "ownerIdField", "title", "description", "time", "owner"),
}


@dataclass(frozen=True)
class Path:
    """Segments from the root entity: relation names, then a column (or self: the key of the entity reached)."""

    hops: tuple[str, ...]
    leaf: str | None

    @staticmethod
    def of(value: Any) -> Path:
        if isinstance(value, str):
            return Path((), value.removeprefix("#"))
        if isinstance(value, dict):
            if value.get("self"):
                return Path((), None)
            items = value.get("items", value.get("path"))
            if isinstance(items, list) and items:
                *hops, last = items
                leaf = None if isinstance(last, dict) and last.get("self") else str(last).removeprefix("#")
                return Path(tuple(str(h).removeprefix("#") for h in hops), leaf)
        raise SpecError(f"not a field: {value!r}")


@dataclass
class ColumnSpec:
    alias: str
    field: Path | None = None
    aggregate: str | None = None
    custom_sql: str | None = None
    formula: str | None = None
    cases: list[dict] = dataclasses.field(default_factory=list)
    separator: str = ","
    order_by: Path | None = None
    visible: bool = True
    detail: dict | None = None


@dataclass
class ReportSpec:
    entity: str
    columns: list[ColumnSpec]
    raw: dict

    def get(self, key: str, default: Any = None) -> Any:
        return self.raw.get(key, default)


def validate(raw: dict) -> list[tuple[str, str]]:
    """(place, message) for all that is wrong with a report."""
    out = [(k, "refused: raw hook") for k in _REFUSED if raw.get(k)]
    out += [(k, "unknown key") for k in sorted(raw) if k not in KNOWN_KEYS and k not in _REFUSED]
    if not (raw.get("entity") or raw.get("parent")):
        out.append(("entity", "missing"))
    names = [p.get("name") for p in raw.get("parameters", [])]
    out += [("parameters", f"{n} is named twice") for n in sorted({n for n in names if names.count(n) > 1}, key=str)]
    for key in ("condition", "treeCondition"):
        if raw.get(key):
            out += condition_findings(raw[key], key)
    for i, c in enumerate(raw.get("columns", [])):
        if c.get("aggregate") not in (None, *AGGREGATES):
            out.append((f"columns[{i}]", f"unknown aggregate {c['aggregate']}"))
        if not {"field", "customSql", "formula", "cases", "aggregate", "detail"} & c.keys():
            out.append((f"columns[{i}]", "a column needs a field or an expression"))
    for i, s in enumerate(raw.get("sorting", [])):
        if s.get("direction", "asc") not in _SORTS:
            out.append((f"sorting[{i}]", f"unknown direction {s['direction']}"))
    if raw.get("sqlGrouping"):
        grouped = set(raw["sqlGrouping"])
        for i, c in enumerate(raw.get("columns", [])):
            if not c.get("aggregate") and c.get("alias") not in grouped and "path" not in (c.get("detail") or {}):
                out.append((f"columns[{i}]", "neither grouped nor aggregated"))
    for kind, known in ROLES.items():
        roles = raw.get(kind) or {}
        if not isinstance(roles, dict):
            out.append((kind, "must name fields by role"))
            continue
        out += [(f"{kind}.{role}", "unknown role") for role in sorted(roles) if role not in known]
    top = raw.get("top")
    if top is not None and (not isinstance(top, int) or top < 0):
        out.append(("top", "must be a count"))
    return out


def load(report: str | dict) -> ReportSpec:
    """A report from JSON text (a byte order mark is allowed) or an object; raises SpecError with all findings."""
    raw = json.loads(report.removeprefix("﻿")) if isinstance(report, str) else report
    if wrong := validate(raw):
        raise SpecError("; ".join(f"{a}: {b}" for a, b in wrong))
    columns, used = [], set()
    for i, c in enumerate(raw.get("columns", [])):
        if not c.get("enabled", True) or c.get("alias") in raw.get("ignoreColumns", []):
            continue
        alias = c.get("alias") or ""
        if not alias or alias in used:
            alias = f"~{i}"
        used.add(alias)
        columns.append(
            ColumnSpec(
                alias, Path.of(c["field"]) if "field" in c else None, c.get("aggregate"), c.get("customSql"), c.get("formula"), c.get("cases", []),
                c.get("separator", ","), Path.of(c["orderBy"]) if "orderBy" in c else None, c.get("visible", True), c.get("detail"),
            )
        )
    return ReportSpec((raw.get("entity") or raw["parent"]).removeprefix("#"), columns, raw)
