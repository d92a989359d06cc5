"""Operators on the model that metadata becomes: routing by type, scoped keys, catalogues, plans of changes and their outcome."""

from __future__ import annotations

from functools import reduce
from itertools import count
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import SpecError
from ..functions.text import fold_match
from .match import ranked_first
from .tables import free, stored

#: Letters that one side writes and the other reads, Arabic to Persian.
ARABIC, PERSIAN = "يك", "یک"


def unknown_columns(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with columns that cannot be decoded: NULL of a type, which is unknown, not empty."""
    return rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items()))


def to_application(text: Column) -> Column:
    """Letters of stored text as the application writes them."""
    return F.translate(text, ARABIC, PERSIAN)


def to_storage(text: Column) -> Column:
    return F.translate(text, PERSIAN, ARABIC)


def scoped_key(owner: Column, name: Column) -> Column:
    """owner/folded name; NULL unless both are there: a bare name is no key."""
    return F.when((F.trim(owner) != "") & (F.trim(name) != ""), F.concat_ws("/", owner, fold_match(name)))


#: Routes up to this number are broadcast; more are joined by a shuffle.
FEW_ROUTES = 10_000


def _routes(routes: DataFrame) -> DataFrame:
    return F.broadcast(routes) if routes.limit(FEW_ROUTES + 1).count() <= FEW_ROUTES else routes


def route(rows: DataFrame, kind: str, routes: DataFrame) -> DataFrame:
    """rows with collection, from routes(kind, collection); NULL where a kind has no route."""
    known = routes.select(F.col("kind").alias(kind), "collection")
    return rows.join(_routes(known), kind, "left")


def unrouted(rows: DataFrame, kind: str, id_col: str, routes: DataFrame, samples: int = 5) -> DataFrame:
    """(kind, rows, samples) of the kinds without a route: kept and counted, with the smallest ids."""
    left = rows.join(_routes(routes.select(F.col("kind").alias(kind))), kind, "left_anti")
    return left.groupBy(kind).agg(F.count("*").alias("rows")).join(ranked_first(left, kind, id_col, samples).withColumnRenamed("first", "samples"), kind)


def nested_paths(rows: DataFrame, id_col: str, parent_col: str, name_col: str) -> DataFrame:
    """(id, path, parent_path): slash paths from nesting, level by level, however deep; a row without a parent among rows is a root.

    A cycle has no path. An id that stands below itself, as it repeats with another parent, is an error.
    """
    base = rows.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"), F.col(name_col).cast("string").alias("name"))
    known = base.select(F.col("id").alias("up"))
    none = F.lit(None).cast("string")
    done = level = stored(base.where("up is null").unionByName(base.where("up is not null").join(known, "up", "left_anti")).select("id", F.col("name").alias("path"), none.alias("parent_path")), "paths")
    rows_in = base.count()
    for depth in count(1):
        if depth > rows_in + 1:
            raise SpecError("an id stands below itself")
        above = level.select(F.col("id").alias("up"), F.col("path").alias("above"))
        level = stored(base.join(above, "up").select("id", F.concat_ws("/", "above", "name").alias("path"), F.col("above").alias("parent_path")), "paths")
        if level.isEmpty():
            break
        done = done.unionByName(level)
    return done


def inline_code(rows: DataFrame, id_col: str, json_col: str, path: str = "$.formula.code") -> DataFrame:
    """(id, code_length) of the records that hold code: its length, never its text."""
    code = F.get_json_object(json_col, path)
    return rows.where(code.isNotNull()).select(id_col, F.length(code).alias("code_length"))


def selector_catalogue(uses: DataFrame, declaring: list[str]) -> DataFrame:
    """(selector, keys, declared, referenced) of uses(selector, key): keys in declaring declare, all others refer."""
    keys = F.collect_set("key")
    out = uses.groupBy("selector").agg(F.array_sort(keys).alias("keys"))
    known = F.array(*(F.lit(k) for k in declaring))
    return out.withColumn("declared", F.arrays_overlap("keys", known)).withColumn("referenced", F.size(F.array_except("keys", known)) > 0)


def selector_index(parts: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(object_type, selector, id) of all rows that have a selector; parts: type to (rows, id, selector)."""
    each = [d.where(F.col(s).isNotNull()).select(F.lit(k).alias("object_type"), F.col(s).alias("selector"), F.col(i).cast("string").alias("id")) for k, (d, i, s) in parts.items()]
    return reduce(DataFrame.unionByName, each)


def compared_together(left: list[DataFrame], right: list[DataFrame], key: str) -> DataFrame:
    """(key, side): the collections of each side as one, and where each key stands: both, left or right."""
    one = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(key).where(F.col(key).isNotNull()).distinct()
    a, b = one(left).withColumn("_l", F.lit(True)), one(right).withColumn("_r", F.lit(True))
    return a.join(b, key, "full").select(key, F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right").alias("side"))


def of_source(rows: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose provenance is among sources."""
    return rows.join(sources.select(*keys).distinct(), keys, "left_semi")


def declared_columns(columns: DataFrame, declared: DataFrame) -> DataFrame:
    """(table, column, declared): columns whose name looks like an id, and whether the package declares them, whatever their case."""
    shaped = columns.where(F.lower("column").rlike("(id|key)$"))
    known = declared.select(F.lower("table").alias("_t"), F.lower("column").alias("_c"), F.lit(True).alias("declared")).distinct()
    met = shaped.join(known, (F.lower("table") == F.col("_t")) & (F.lower("column") == F.col("_c")), "left")
    return met.select("table", "column", F.coalesce("declared", F.lit(False)).alias("declared"))


def sample_binding(columns: DataFrame, owner: str, usable: Column) -> DataFrame:
    """The owner with the most usable columns, the smallest of equals: (owner, n)."""
    return columns.where(usable).groupBy(owner).agg(F.count("*").alias("n")).orderBy(F.desc("n"), owner).limit(1)


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, order of the first): distinct keys with the place where each was first seen."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first")).select(*keys, *(F.col(f"_first.{o}").alias(f"first_{o}") for o in order))


def queue_positions(rows: DataFrame, pending: Column, order: list[str], queue: str) -> DataFrame:
    """rows that are pending with position, from 1 in each queue by order."""
    return rows.where(pending).withColumn("position", F.row_number().over(Window.partitionBy(queue).orderBy(*order)))


def composite_order(rows: DataFrame, keys: dict[str, Any]) -> DataFrame:
    """rows sorted by keys, a NULL counting as the value given for its key."""
    return rows.orderBy(*(F.coalesce(F.col(k), F.lit(v)) for k, v in keys.items()))


def unknown_parameters(used: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """The keys used that no report declares."""
    return used.select(*keys).distinct().join(declared.select(*keys), keys, "left_anti")


def batch_status(commands: DataFrame, batch: str, ok: Column) -> DataFrame:
    """(batch, commands, failed, status): succeeded, failed, or partiallySucceeded: a batch is not atomic."""
    out = commands.groupBy(batch).agg(F.count("*").alias("commands"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"))
    status = F.when(F.col("failed") == 0, "succeeded").when(F.col("failed") == F.col("commands"), "failed").otherwise("partiallySucceeded")
    return out.withColumn("status", status)


def apply_phases(commands: DataFrame, operation: str, phases: dict[str, int]) -> DataFrame:
    """commands with phase: the order in which operations are applied; an unknown operation is an error row, phase NULL."""
    table = F.create_map(*(x for k, v in phases.items() for x in (F.lit(k), F.lit(v))))
    return commands.withColumn("phase", F.try_element_at(table, F.col(operation)))


def read_back(requested: DataFrame, actual: DataFrame, key: str, properties: list[str]) -> DataFrame:
    """(key, property, requested, actual, applied) of the properties that a patch asks for (not NULL), and of no others."""
    long = lambda d, v: d.select(key, F.explode(F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).cast("string").alias(v)) for p in properties))).alias("s")).select(key, "s.*")
    asked = long(requested, "requested").where("requested is not null")
    return asked.join(long(actual, "actual"), [key, "property"], "left").withColumn("applied", F.col("requested").eqNullSafe(F.col("actual")))


def remapped(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(old, target, new): edges(id, target) of an import with new ids, from ids(old, new); an id that is not imported stays as it is."""
    to = ids.select(F.col("old").alias("target"), F.col("new").alias("new_target"))
    out = edges.join(ids.select(F.col("old").alias("id"), "new"), "id", "left").join(to, "target", "left")
    return out.select(F.coalesce("new", "id").alias("id"), F.coalesce("new_target", "target").alias("target"))


def current_records(records: DataFrame, key: str, valid: Column, order: str) -> DataFrame:
    """(key, record, ambiguous): the last valid record of each key; ambiguous where several stand at its moment, and then none is chosen."""
    live = records.where(valid)
    last = live.groupBy(key).agg(F.max(order).alias(order))
    out = live.join(last, [key, order]).groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct(*[c for c in records.columns if c != key])).alias("record"))
    return out.select(key, F.when(F.col("n") == 1, F.col("record")).alias("record"), (F.col("n") > 1).alias("ambiguous"))


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(node) of a workflow's graph, edges(src, dst), that a path from starts(node) reaches, starts included."""
    seen = front = stored(starts.select("node").distinct(), "reach")
    while True:
        step = edges.join(front.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti")
        front = stored(step, "reach")
        if front.isEmpty():
            free(front)
            return seen
        seen = stored(seen.unionByName(front), "reach")


def substituted(tree: Any, values: dict[str, Any]) -> Any:
    """A template with each text {{name}} replaced by the value of name; a name without one is an error."""
    if isinstance(tree, dict):
        return {k: substituted(v, values) for k, v in tree.items()}
    if isinstance(tree, list):
        return [substituted(v, values) for v in tree]
    if isinstance(tree, str) and tree.startswith("{{") and tree.endswith("}}"):
        if tree[2:-2] not in values:
            raise SpecError(f"no value for {tree}")
        return values[tree[2:-2]]
    return tree


def comparison_views(left: DataFrame, right: DataFrame, key: str, value: str, kind: str) -> dict[str, DataFrame]:
    """Five views of one comparison by key: missing, extra, mismatched values and types, and equivalent keys."""
    side = lambda d, s: d.select(key, F.col(value).alias(f"{s}_value"), F.col(kind).alias(f"{s}_kind"), F.lit(True).alias(f"_{s}"))
    both = side(left, "left").join(side(right, "right"), key, "full")
    met = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    same_kind = F.col("left_kind").eqNullSafe(F.col("right_kind"))
    same = F.col("left_value").eqNullSafe(F.col("right_value"))
    tests = {
        "missing": F.col("_right").isNull(),
        "extra": F.col("_left").isNull(),
        "mismatched_types": met & ~same_kind,
        "mismatched_values": met & same_kind & ~same,
        "equivalent": met & same_kind & same,
    }
    return {name: both.where(test).drop("_left", "_right") for name, test in tests.items()}


def catalogue_of_systems(index: DataFrame, pack: DataFrame, reason: str) -> DataFrame:
    """index(id, caption) with authorable and why not: a system that the pack lacks is kept, with the reason. Authorable ones come first."""
    known = pack.select("id", F.lit(True).alias("authorable")).distinct()
    out = index.join(known, "id", "left").withColumn("authorable", F.coalesce("authorable", F.lit(False)))
    out = out.withColumn("reason", F.when(~F.col("authorable"), F.lit(reason)))
    return out.orderBy(F.desc("authorable"), F.coalesce("caption", F.col("id").cast("string")))


def capabilities(declared: DataFrame, found: DataFrame) -> DataFrame:
    """declared(capability, family) with status by the source families that show it: confirmed (all), partial or unconfirmed."""
    met = declared.join(found.select("capability", "family").distinct().withColumn("_f", F.lit(True)), ["capability", "family"], "left")
    out = met.groupBy("capability").agg(F.count("*").alias("families"), F.count("_f").alias("shown"))
    return out.withColumn("status", F.when(F.col("shown") == F.col("families"), "confirmed").when(F.col("shown") > 0, "partial").otherwise("unconfirmed"))


def unsupported_inferences(claims: DataFrame, evidence: DataFrame, key: str, inferred: Column) -> DataFrame:
    """Inferred claims that no evidence stands behind."""
    return claims.where(inferred).join(evidence.select(key).distinct(), key, "left_anti")


def contract_rows(properties: DataFrame, groups: DataFrame) -> DataFrame:
    """properties(property, ...) with the group of each, from groups(property, group); grouped twice or not at all is told by groups_of."""
    n = groups.groupBy("property").agg(F.count("*").alias("groups_of"), F.min("group").alias("group"))
    return properties.join(n, "property", "left").withColumn("groups_of", F.coalesce("groups_of", F.lit(0)))


def with_provenance(rows: DataFrame, source: str, path: str, confidence: str) -> DataFrame:
    """rows with the provenance that every output carries."""
    return rows.select("*", F.lit(source).alias("_source"), F.lit(path).alias("_path"), F.lit(confidence).alias("_confidence"))
