"""ReportSpec to DataFrame: joins by relation path, filter, group, distinct, sort, top, projection.

Nothing is executed here but the pivot values of a matrix, if the report doesn't list them.
"""

from __future__ import annotations

import dataclasses
import re
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import Catalog, Relation
from ..errors import SpecError, UnsupportedSemantics
from ..operators.hierarchy import descend
from ..operators.tables import stored
from .access import Restricted
from .conditions import Bindings, is_leaf, predicate
from .customsql import screened
from .spec import ROLES, ColumnSpec, Path, ReportSpec, load

MONEY = "decimal(28,4)"


class _Source:
    """The root entity and every relation prefix that the report uses, each joined once."""

    def __init__(self, catalog: Catalog, entity: str, aliases: dict[str, Path] | None = None) -> None:
        self.catalog, self.root = catalog, catalog.entity(entity)
        self.aliases = aliases or {}
        self.df = self._named(entity, ())
        self.at: dict[tuple[str, ...], str] = {(): self.root.name}

    def _named(self, entity: str, hops: tuple[str, ...]) -> DataFrame:
        rows = self.catalog.rows(entity)
        return rows.select(*(F.col(f"`{c}`").alias(self.name(hops, c)) for c in rows.columns))

    @staticmethod
    def name(hops: tuple[str, ...], column: str) -> str:
        return "/".join((*hops, column))

    def join(self, hops: tuple[str, ...]) -> str:
        """The entity reached; joins what is missing. A shared prefix is joined once."""
        if hops in self.at:
            return self.at[hops]
        before, relation = hops[:-1], hops[-1]
        if not before and relation in self.aliases:  # a named instance of its own of what its path reaches
            before, relation = self.aliases[relation].hops, self.aliases[relation].leaf
        source = self.join(before)
        r = self.catalog.relation(source, relation)
        if r is None:
            raise SpecError(f"{source} has no relation {relation}")
        right = self._named(r.target, hops)
        on = F.col(f"`{self.name(before, r.source_key)}`") == F.col(f"`{self.name(hops, r.target_key)}`")
        self.df = self.df.join(right, on, "left")
        self.at[hops] = r.target
        return r.target

    def column(self, path: Path) -> Column:
        entity = self.join(path.hops)
        leaf = path.leaf or self.catalog.entity(entity).id
        if r := self.catalog.relation(entity, leaf):  # a relation as a value is its key
            if not r.many:
                leaf = r.source_key
        name = self.name(path.hops, leaf)
        if name not in self.df.columns:
            raise SpecError(f"{entity} has no field {leaf}")
        return F.col(f"`{name}`")

    def type(self, field: Any) -> T.DataType:
        path = Path.of(field)
        self.column(path)
        entity = self.at[path.hops]
        leaf = path.leaf or self.catalog.entity(entity).id
        name = self.name(path.hops, leaf)
        return self.df.schema[name].dataType if name in self.df.columns else T.LongType()

    def is_money(self, path: Path | None) -> bool:
        return path is not None and path.leaf in self.catalog.entity(self.join(path.hops)).money


def bindings_of(spec: ReportSpec, bind: Bindings) -> Bindings:
    """bind with the report's own parameters: a given value, a constant, or a runtime context value."""
    values = {}
    for p in spec.get("parameters", []):
        name = p["name"]
        if name in bind.values:
            values[name] = bind.values[name]
        elif p.get("external"):
            values[name] = _of_parent(name, bind.parent)
        elif p.get("contextValue"):
            values[name] = bind.runtime(p["contextValue"])
        elif "value" in p:
            values[name] = p["value"]
    return dataclasses.replace(bind, values={**bind.values, **values})


def _of_parent(name: str, parent: dict[str, Any] | None) -> Any:
    """The value of an external parameter: the parent object's Id, or its field whose caption is the parameter's name."""
    if parent is None or name not in parent:
        raise SpecError(f"external parameter {name} needs a parent object that has it")
    return parent[name]


def with_access(catalog: Catalog, spec: ReportSpec, bind: Bindings) -> Catalog:
    """The catalog as the report may see it. A report without rules on must be allowed to: it never gets there on its own."""
    if bind.access is None:
        return catalog
    base = catalog.base if isinstance(catalog, Restricted) else catalog
    if spec.get("ignoreAdvancedSecurityCondition") or not spec.get("useAdvancedAccess", True):
        if not bind.may_ignore_access:
            raise SpecError("the report asks for rows without access rules, which this run doesn't allow")
        return base
    if isinstance(catalog, Restricted):
        return catalog

    def filtered(of: Catalog, entity: str, condition: dict) -> DataFrame:
        src = _Source(of, entity)
        columns = src.df.columns

        def column(f: Any) -> Column:
            path = Path.of(f)
            if _many(src, path):
                raise SpecError(f"access rule of {entity}: {f!r} passes a relation to many rows")
            return src.column(path)

        where = predicate(condition, column, bind, src.type)
        return src.df.where(where).select(*(f"`{c}`" for c in columns))

    return Restricted(base, bind.access, filtered)


def aliases_of(spec: ReportSpec, catalog: Catalog) -> dict[str, Path]:
    """The report's named join instances. A name may not hide a relation of the root, nor stand twice."""
    out: dict[str, Path] = {}
    for a in spec.get("joinAliases", []):
        name = a.get("name")
        if not name or name in out or catalog.relation(spec.entity, name):
            raise SpecError(f"joinAliases: {name!r} is missing, repeated or a relation of {spec.entity}")
        out[name] = Path.of(a["field"])
    return out


def compile_report(catalog: Catalog, report: str | dict, bind: Bindings | None = None) -> DataFrame:
    """The report's rows. Bindings supply parameters, as_of and the current user."""
    spec = load(report)
    unsupported(spec.raw)
    bind = bindings_of(spec, bind or Bindings())
    catalog = with_access(catalog, spec, bind)
    if spec.get("selfReferencingField"):
        return _tree(catalog, spec, bind)
    src = _Source(catalog, spec.entity, aliases_of(spec, catalog))
    _apply_detail(src, spec, bind)
    _filter(src, catalog, spec, bind)
    if spec.get("matrix"):
        return _matrix(src, spec)
    columns = [(c, _expression(src, c, bind)) for c in spec.columns]
    _roles(src, spec)  # joins what they reach
    if spec.get("additionalWhere"):
        src.df = src.df.where(F.expr(screened(spec.get("additionalWhere"), bind.as_of)))
    if spec.get("sqlGrouping") or any(c.aggregate for c in spec.columns):
        keys = [e.alias(c.alias) for c, e in columns if not _is_value(c, spec)]
        values = [(_merged(c) if c.detail else _aggregate(src, c)).alias(c.alias) for c in spec.columns if _is_value(c, spec)]
        out = (src.df.groupBy(*keys) if keys else src.df).agg(*values)
        out = out.select(*(f"`{c.alias}`" for c in spec.columns))
        if spec.get("useSummaryRow"):
            out = _with_summary(out, src.df, keys, values, spec)
    else:
        roles = _roles(src, spec)
        out = src.df.select(*(e.alias(c.alias) for c, e in columns), *(e.alias(n) for n, e in roles))
    for other in spec.get("subReports", []):
        more = compile_report(catalog, other, bind)
        out = out.unionByName(more, allowMissingColumns=True)
    if spec.get("isDistinct"):
        out = out.distinct()
    return _finish(out, spec)


def _roles(src: _Source, spec: ReportSpec) -> list[tuple[str, Column]]:
    """The columns of a calendar's or forum's roles: (calendar:startDate, its field). A role that names a column of the report is that column.

    A grouped report has no rows for other fields: there every role has to name a column.
    """
    out, known = [], {c.alias for c in spec.columns}
    for kind in ROLES:
        for role, value in (spec.get(kind) or {}).items():
            if isinstance(value, str) and value in known:
                continue
            if spec.get("sqlGrouping") or any(c.aggregate for c in spec.columns):
                raise SpecError(f"{kind}.{role}: a grouped report has no column {value!r}")
            path = Path.of(value)
            if _many(src, path):
                raise SpecError(f"{kind}.{role} passes a relation to many rows")
            out.append((f"{kind}:{role}", src.column(path)))
    return out


def _is_value(c: ColumnSpec, spec: ReportSpec) -> bool:
    """Whether a grouped report aggregates the column: its own aggregate, or the states of a path that isn't grouped by."""
    return bool(c.aggregate) or bool(c.detail and "path" in c.detail and c.alias not in (spec.get("sqlGrouping") or ()))


def _filter(src: _Source, catalog: Catalog, spec: ReportSpec, bind: Bindings) -> None:
    """The report's condition, and deleted rows out unless they are asked for."""
    src.df, condition = _semi_joins(src, catalog, spec, bind)
    if condition:
        where = predicate(condition, lambda f: src.column(Path.of(f)), bind, src.type)
        src.df = src.df.where(where)
    if src.root.deleted and not spec.get("includeDeleted"):
        src.df = src.df.where(~F.col(f"`{src.root.deleted}`"))


def count_rows(catalog: Catalog, report: dict, bind: Bindings | None = None) -> int | None:
    """Rows of all pages; None where the report says not to count."""
    if report.get("dontExecuteCount"):
        return None
    whole = {k: v for k, v in report.items() if k not in ("pageSize", "pageIndex", "sorting")}
    return compile_report(catalog, whole, bind).count()


def _finish(out: DataFrame, spec: ReportSpec) -> DataFrame:
    order = [F.col(f"`{s['alias']}`").desc() if s.get("direction") == "desc" else F.col(f"`{s['alias']}`").asc() for s in spec.get("sorting", [])]
    if spec.get("showRowNumber"):
        if not order:
            raise SpecError("showRowNumber needs a sorting")
        out = _row_numbers(out, order)
    for rule in spec.get("formatConditions", []):
        test = predicate(rule["condition"], lambda f: F.col(f"`{f}`"), Bindings())
        out = out.withColumn(f"format:{rule['name']}", F.when(test, F.lit(rule["style"])))
    if order:
        out = out.orderBy(*order)
    size = spec.get("pageSize")
    if spec.get("pagingType", "Default") != "None" and size:
        out = out.offset(size * spec.get("pageIndex", 0)).limit(size)
    if spec.get("top") is not None:
        out = out.limit(spec.get("top"))
    hidden = [c.alias for c in spec.columns if not c.visible]
    return out.drop(*hidden)


def _row_numbers(out: DataFrame, order: list[Column]) -> DataFrame:
    """Consecutive numbers in order, without one task for all rows: range partitions number their own rows after the counts before."""
    # written once: two readings of a range partitioning may draw different bounds
    ranged = stored(out.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "row-numbers")
    local = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = ranged.groupBy("_part").count()
    # a row for each partition, not for each row of data
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return local.join(F.broadcast(before), "_part").withColumn("row_number", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def _expression(src: _Source, c: ColumnSpec, bind: Bindings) -> Column | None:
    if c.aggregate:
        if c.field and not _many(src, c.field):
            src.column(c.field)
        return None
    if c.detail:
        return F.col(f"`detail:{c.alias}`")
    if c.custom_sql:
        return F.expr(screened(c.custom_sql, bind.as_of))
    if c.cases:
        return _cases(src, c.cases, bind)
    if c.formula:
        return formula(src, c.formula)
    return src.column(c.field)


def _many(src: _Source, path: Path) -> Relation | None:
    entity = src.root.name
    for h in path.hops:
        r = src.catalog.relation(entity, h)
        if r is None:
            raise SpecError(f"{entity} has no relation {h}")
        if r.many:
            return r
        entity = r.target
    return None


def _cases(src: _Source, cases: list[dict], bind: Bindings) -> Column:
    """Ordered branches; at most one else, and nothing after it."""
    out = None
    for i, case in enumerate(cases):
        if "else" in case:
            if i != len(cases) - 1:
                raise SpecError("a branch after else is never reached")
            return (out if out is not None else F.when(F.lit(False), None)).otherwise(F.lit(case["else"]))
        test = predicate(case["when"], lambda f: src.column(Path.of(f)), bind, src.type)
        out = F.when(test, F.lit(case["then"])) if out is None else out.when(test, F.lit(case["then"]))
    return out


_TOKEN = re.compile(r"\s*(?:(\{[^}]*\}(?:\.\{[^}]*\})*)|(\d+(?:\.\d+)?)|([-+*/()]))")


def formula(src: _Source, text: str) -> Column:
    """Arithmetic over captions: {Price} * (1 - {Discount}), {Customer}.{Name}; a caption is resolved in its entity."""
    tokens, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise SpecError(f"formula: cannot read {text[at:]!r}")
        tokens.append(m)
        at = m.end()
    tokens.append(None)
    pos = 0

    def caption(ref: str) -> Column:
        entity, hops, names = src.root.name, [], re.findall(r"\{([^}]*)\}", ref)
        for i, n in enumerate(names):
            known = src.catalog.entity(entity).captions
            if n not in known:
                raise SpecError(f"formula: {entity} has no caption {n}")
            if i < len(names) - 1:
                r = src.catalog.relation(entity, known[n])
                if r is None:
                    raise SpecError(f"formula: {n} is not a relation")
                hops.append(known[n])
                entity = r.target
        return src.column(Path(tuple(hops), known[names[-1]]))

    def peek() -> str | None:
        return tokens[pos][3] if tokens[pos] else None

    def atom() -> Column:
        nonlocal pos
        m = tokens[pos]
        pos += 1
        if m is None:
            raise SpecError("formula: ends early")
        if m[1]:
            return caption(m[1])
        if m[2]:
            return F.lit(float(m[2]) if "." in m[2] else int(m[2]))
        if m[3] == "-":
            return -atom()
        if m[3] == "(":
            inner = total()
            if peek() != ")":
                raise SpecError("formula: missing )")
            pos += 1
            return inner
        raise SpecError(f"formula: unexpected {m[3]}")

    def product() -> Column:
        nonlocal pos
        left = atom()
        while peek() in ("*", "/"):
            op = peek()
            pos += 1
            right = atom()
            left = left * right if op == "*" else left / right
        return left

    def total() -> Column:
        nonlocal pos
        left = product()
        while peek() in ("+", "-"):
            op = peek()
            pos += 1
            right = product()
            left = left + right if op == "+" else left - right
        return left

    out = total()
    if tokens[pos] is not None:
        raise SpecError("formula: something follows the end")
    return out


def _aggregate(src: _Source, c: ColumnSpec) -> Column:
    if c.aggregate == "custom":
        return F.expr(_screened_aggregate(c.custom_sql))
    col = src.column(c.field) if c.field else F.lit(1)
    money = src.is_money(c.field)
    exact = col.cast(MONEY) if money else col
    order = src.column(c.order_by) if c.order_by else col
    makers = {
        "count": lambda: F.count(col),
        "sum": lambda: F.sum(exact).cast("double") if money else F.sum(col),
        "min": lambda: F.min(col),
        "max": lambda: F.max(col),
        "avg": lambda: (F.sum(exact).cast("double") / F.count(col)) if money else F.avg(col),
        "first": lambda: F.min_by(col, order),
        "stringConcat": lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), col.cast("string").alias("v")))), lambda s: s["v"]), c.separator),
        "exists": lambda: F.count(col) > 0,
        "notExists": lambda: F.count(col) == 0,
    }
    return makers[c.aggregate]()


def _screened_aggregate(sql: str | None) -> str:
    if not sql:
        raise SpecError("a custom aggregate needs customSql")
    inner = re.sub(r"\b(sum|count|min|max|avg)\s*\(", "coalesce(", sql, flags=re.I)
    screened(inner)
    return sql


def _with_summary(out: DataFrame, rows: DataFrame, keys: list[Column], values: list[Column], spec: ReportSpec) -> DataFrame:
    """The groups and one row over all of them, marked by is_summary; keys are NULL there."""
    total = rows.agg(*values)
    blank = [F.lit(None).cast(out.schema[c.alias].dataType).alias(c.alias) for c in spec.columns if not _is_value(c, spec)]
    total = total.select(*blank, *(F.col(f"`{c.alias}`") for c in spec.columns if _is_value(c, spec)), F.lit(True).alias("is_summary"))
    return out.withColumn("is_summary", F.lit(False)).unionByName(total)


def _matrix(src: _Source, spec: ReportSpec) -> DataFrame:
    m = spec.get("matrix")
    rows, cols = Path.of(m["vertical"]), Path.of(m["horizontal"])
    value = ColumnSpec("value", Path.of(m["value"]) if "value" in m else None, m.get("aggregate", "sum"))
    cell = _aggregate(src, value)
    grouped = src.df.groupBy(src.column(rows).alias(m.get("alias", rows.leaf)))
    column = "/".join((*cols.hops, cols.leaf))
    src.column(cols)
    pivot = src.df.groupBy(src.column(rows).alias(m.get("alias", rows.leaf))).pivot(column, m["values"]) if "values" in m else grouped.pivot(column)
    if spec.get("useSummaryRow"):
        raise UnsupportedSemantics("a matrix has no summary row")
    out = pivot.agg(cell)
    order = [F.col(f"`{s['alias']}`").desc() if s.get("direction") == "desc" else F.col(f"`{s['alias']}`").asc() for s in spec.get("sorting", [])]
    out = out.orderBy(*order) if order else out
    return out.limit(spec.get("top")) if spec.get("top") is not None else out


def _semi_joins(src: _Source, catalog: Catalog, spec: ReportSpec, bind: Bindings) -> tuple[DataFrame, dict | None]:
    """inList and notInList over a report's first column, where they are conjuncts: semi and anti joins.

    An anti join keeps its meaning when the list holds NULL, which NOT IN does not.
    """
    condition = spec.get("condition")
    if not condition:
        return src.df, None
    marks = iter(range(1 << 30))

    def listed(leaf: dict) -> tuple[Column, DataFrame] | None:
        value = leaf.get("value") if is_leaf(leaf) else None
        if not isinstance(value, dict) or "report" not in value or not leaf.get("enabled", True):
            return None
        if leaf["operator"] not in ("inList", "notInList"):
            raise SpecError("a report is a value for lists only")
        other = compile_report(catalog, value["report"], bind)
        return src.column(Path.of(leaf["field"])), other.select(F.col(f"`{other.columns[0]}`").alias("_listed")).where("_listed is not null").distinct()

    def marked(node: dict) -> dict:
        """Deeper in the tree: a column tells whether the value is listed, and the clause asks for it."""
        if not is_leaf(node):
            return {k: [marked(x) for x in v] if k in ("all", "any") else v for k, v in node.items()}
        found = listed(node)
        if found is None:
            return node
        name = f"_listed{next(marks)}"
        src.df = src.df.join(found[1].withColumnRenamed("_listed", name), found[0] == F.col(name), "left")
        return {"field": name, "operator": "isNotNull" if node["operator"] == "inList" else "isNull"}

    if "any" in condition:
        condition = marked(condition)
        return src.df, condition
    rest = []
    for node in [condition] if is_leaf(condition) else condition["all"]:
        found = listed(node)
        if found is None:
            rest.append(marked(node))
        else:
            src.df = src.df.join(found[1], found[0] == F.col("_listed"), "left_semi" if node["operator"] == "inList" else "left_anti")
    return src.df, {"all": rest} if rest else None


def _where(src: _Source, condition: dict, bind: Bindings) -> None:
    test = predicate(condition, lambda f: src.column(Path.of(f)), bind, src.type)
    src.df = src.df.where(test)  # after the joins that the condition's paths have made


def _apply_detail(src: _Source, spec: ReportSpec, bind: Bindings) -> None:
    """Aggregates over a many-relation, computed by key before the join: the parent's rows are not multiplied.

    detail: {relation, aggregate, field, condition, excludeSelf}. excludeSelf, for a relation of an entity to itself,
    leaves a row's own part out of its count, sum or existence: it is taken from the total, and no pairs are made.
    """
    for c in spec.columns:
        if not c.detail:
            continue
        d = c.detail
        if "path" in d:
            _apply_path(src, c, bind)
            continue
        r = src.catalog.relation(src.root.name, d["relation"])
        if r is None or not r.many:
            raise SpecError(f"{src.root.name} has no detail relation {d['relation']}")
        inner = _Source(src.catalog, r.target)
        if d.get("condition"):
            _where(inner, d["condition"], bind)
        item = ColumnSpec("v", Path.of(d["field"]) if "field" in d else None, d["aggregate"], d.get("customSql"), separator=d.get("separator", ","))
        key = f"detail-key:{c.alias}"
        name = f"detail:{c.alias}"
        agg = inner.df.groupBy(F.col(f"`{r.target_key}`").alias(key)).agg(_aggregate(inner, item).alias(name))
        src.df = src.df.join(agg, F.col(f"`{r.source_key}`") == F.col(f"`{key}`"), "left").drop(key)
        if d.get("excludeSelf"):
            _without_self(src, r, d, name, bind)
        empty = {"count": F.lit(0).cast("long"), "exists": F.lit(False), "notExists": F.lit(True)}.get(d["aggregate"])
        if empty is not None:
            src.df = src.df.withColumn(name, F.coalesce(F.col(f"`{name}`"), empty))


#: States of an aggregate that can be merged: (name, its value over rows, how values are merged).
_STATES: dict[str, list[tuple[str, Any, Any]]] = {
    "count": [("n", F.count, F.sum)],
    "sum": [("sum", F.sum, F.sum)],
    "avg": [("sum", F.sum, F.sum), ("n", F.count, F.sum)],
    "min": [("min", F.min, F.min)],
    "max": [("max", F.max, F.max)],
    "exists": [("n", F.count, F.sum)],
    "notExists": [("n", F.count, F.sum)],
}


def _apply_path(src: _Source, c: ColumnSpec, bind: Bindings) -> None:
    """A total over a path of relations, of which any may lead to many rows: {path, field, aggregate}.

    Each hop is aggregated by its key below the join with the hop before it, and what is joined and aggregated again are
    states, not rows: no join multiplies rows, and no other column's total is counted twice. A step of the path is a
    relation's name, or {"relation", "condition"}. In a grouped report the states of its rows are merged once more.
    """
    d = c.detail
    if d.get("aggregate") not in _STATES or not d["path"] or d.get("excludeSelf"):
        raise SpecError(f"{c.alias}: over a path, one of {', '.join(_STATES)} is defined")
    steps = [s if isinstance(s, dict) else {"relation": s} for s in d["path"]]
    states, key, r = _path_states(src.catalog, src.root.name, steps, d, bind)
    names = {n: f"state:{c.alias}:{n}" for n, *_ in _STATES[d["aggregate"]]}
    mine = states.select(F.col(key).alias(f"state-key:{c.alias}"), *(F.col(n).alias(to) for n, to in names.items()))
    src.df = src.df.join(mine, F.col(f"`{r.source_key}`") == F.col(f"`state-key:{c.alias}`"), "left").drop(f"state-key:{c.alias}")
    src.df = src.df.withColumn(f"detail:{c.alias}", _final(d["aggregate"], {n: F.col(f"`{to}`") for n, to in names.items()}))


def _path_states(catalog: Catalog, entity: str, steps: list[dict], d: dict, bind: Bindings) -> tuple[DataFrame, str, Relation]:
    """(states by key, the key's column, the first relation) of the steps from entity on."""
    step, *rest = steps
    r = catalog.relation(entity, step["relation"])
    if r is None:
        raise SpecError(f"{entity} has no relation {step['relation']}")
    inner = _Source(catalog, r.target)
    if step.get("condition"):
        _where(inner, step["condition"], bind)
    if inner.root.deleted:
        inner.df = inner.df.where(~F.col(f"`{inner.root.deleted}`"))
    if rest:
        below, key, next_ = _path_states(catalog, r.target, rest, d, bind)
        inner.df = inner.df.join(below, F.col(f"`{next_.source_key}`") == F.col(key))
        made = [merge(F.col(n)).alias(n) for n, _, merge in _STATES[d["aggregate"]]]
    else:
        path = Path.of(d["field"]) if "field" in d else None
        if path and _many(inner, path):
            raise SpecError(f"{d['field']!r}: relations to many rows belong to the path")
        value = inner.column(path) if path else F.lit(1)
        if inner.is_money(path) and d["aggregate"] in ("sum", "avg"):
            value = value.cast(MONEY)
        made = [over(value).alias(n) for n, over, _ in _STATES[d["aggregate"]]]
    key = f"_key{len(rest)}"
    return inner.df.groupBy(F.col(f"`{r.target_key}`").alias(key)).agg(*made), key, r


def _final(aggregate: str, states: dict[str, Column]) -> Column:
    """The aggregate of merged states; without any row a count is 0 and a sum is NULL."""
    n = F.coalesce(states["n"], F.lit(0)) if "n" in states else None
    makers = {
        "count": lambda: n.cast("long"), "exists": lambda: n > 0, "notExists": lambda: n == 0, "min": lambda: states["min"], "max": lambda: states["max"],
        "sum": lambda: states["sum"].cast("double"), "avg": lambda: F.when(n > 0, states["sum"].cast("double") / n),
    }
    return makers[aggregate]()


def _merged(c: ColumnSpec) -> Column:
    """The states of a group's rows as one."""
    d = c.detail
    return _final(d["aggregate"], {n: merge(F.col(f"`state:{c.alias}:{n}`")) for n, _, merge in _STATES[d["aggregate"]]})


def _without_self(src: _Source, r: Relation, d: dict, name: str, bind: Bindings) -> None:
    """Take a row's own part from its total, if the relation and the condition hold it."""
    if r.target != src.root.name:
        raise SpecError(f"excludeSelf: {r.name} does not lead back to {src.root.name}")
    mine = F.col(f"`{r.source_key}`") == F.col(f"`{r.target_key}`")
    if d.get("condition"):
        mine &= predicate(d["condition"], lambda f: src.column(Path.of(f)), bind, src.type)
    value = src.column(Path.of(d["field"])) if "field" in d else F.lit(1)
    total, mine = F.col(f"`{name}`"), F.coalesce(mine, F.lit(False))
    if d["aggregate"] in ("exists", "notExists"):
        raise SpecError("excludeSelf: ask for a count, and compare it with 0")
    own = {"count": F.when(mine & value.isNotNull(), 1).otherwise(0), "sum": F.when(mine, F.coalesce(value, F.lit(0))).otherwise(0)}.get(d["aggregate"])
    if own is None:
        raise SpecError(f"excludeSelf is not defined for {d['aggregate']}")
    src.df = src.df.withColumn(name, total - own)


def _tree(catalog: Catalog, spec: ReportSpec, bind: Bindings) -> DataFrame:
    """Rows with their level below a root. Levels come from the whole hierarchy, in which a row that treeCondition rules out
    ends its branch; with useHierarchyConditionForRoot it tells the roots instead. condition then selects rows.
    """
    for key in ("sqlGrouping", "matrix", "subReports", "isDistinct", "useSummaryRow"):
        if spec.get(key):
            raise UnsupportedSemantics(f"a tree report takes no {key}")
    if any(c.aggregate for c in spec.columns):
        raise UnsupportedSemantics("a tree report takes no aggregates")
    aliases = aliases_of(spec, catalog)
    whole = _Source(catalog, spec.entity, aliases)
    parent = Path.of(spec.get("selfReferencingField"))
    up = whole.column(parent)
    if whole.root.deleted and not spec.get("includeDeleted"):
        whole.df = whole.df.where(~F.col(f"`{whole.root.deleted}`"))
    roots = up.isNull()
    if spec.get("treeCondition"):
        holds = predicate(spec.get("treeCondition"), lambda f: whole.column(Path.of(f)), bind, whole.type)
        if spec.get("useHierarchyConditionForRoot"):
            roots = holds
        else:
            whole.df = whole.df.where(holds)
    nodes = whole.df.select(F.col(f"`{whole.root.id}`").alias("_id"), up.alias("_parent"), roots.alias("_root"))
    levels = descend(nodes.select("_id", "_parent"), nodes.where("_root").select("_id"), "_id", "_parent", spec.get("treeAutoOpenLevels"))
    src = _Source(catalog, spec.entity, aliases)
    _apply_detail(src, spec, bind)
    _filter(src, catalog, spec, bind)
    columns = [_expression(src, c, bind).alias(c.alias) for c in spec.columns]
    if spec.get("additionalWhere"):
        src.df = src.df.where(F.expr(screened(spec.get("additionalWhere"), bind.as_of)))
    rows = src.df.select(*columns, F.col(f"`{src.root.id}`").alias("_id"))
    return _finish(rows.join(levels, "_id").drop("_id", "root"), spec)


def unsupported(report: dict) -> None:
    """Raise for report kinds whose rows the model doesn't define."""
    if report.get("reportType") in ("gantt", "form", "dashboard", "print"):
        raise UnsupportedSemantics(f"{report['reportType']} has no rows of its own")
