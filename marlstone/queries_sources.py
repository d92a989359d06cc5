"""Sources as queries: the driver's tables packed as legacy packages and read back as collections of the model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators.tables import new_folder
from .queries import _query, _read
from .sources import packages

#: Tables of the packages: the driver's table behind each, and the cells of its rows as (column, declared type, expression).
_PACKED: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "MET_METASYSTEM": ("nation", [("ID", "long", "n_nationkey"), ("SystemKey", "string", "n_name"), ("Caption", "string", "case when n_regionkey > 1 then n_name || ' & <co>' end"), ("rootFolderId", "long", "100 * n_nationkey"), ("IsInactive", "boolean", "case n_regionkey when 0 then 'true' when 1 then 'False' when 2 then ' 1 ' end")]),
    "MET_TYPEDEF": ("supplier", [("ID", "long", "s_suppkey"), ("DbName", "string", "s_name"), ("systemId", "long", "s_nationkey"), ("isDynamic", "boolean", "case when s_acctbal > 5000 then 'yes' else 'no' end")]),
    "MET_FIELDDEF": ("part", [("ID", "long", "p_partkey"), ("dbName", "string", "p_name"), ("caption", "string", "p_brand"), ("typeDefId", "long", "p_partkey % 10"), ("orderNumber", "int", "case when p_size > 25 then p_size || 'th' else p_size || '' end"), ("fieldInfoType", "string", "p_type")]),
    "met_Relation": ("lineitem", [("ID", "string", "l_orderkey || '/' || l_linenumber"), ("SourceId", "long", "l_orderkey"), ("DestId", "long", "l_partkey"), ("Role", "string", "l_returnflag")]),
    "$basicInfoRelation": ("customer", [("ID", "long", "c_custkey"), ("SourceId", "long", "c_nationkey"), ("DestId", "long", "c_custkey"), ("Role", "string", "c_mktsegment")]),
    "met_Report": ("orders", [("ID", "long", "o_orderkey"), ("Name", "string", "o_orderpriority"), ("systemId", "long", "o_custkey"), ("reportType", "string", "o_orderstatus")]),
}
_COLLECTIONS = ("system", "entities", "fields", "relations", "reports")


def _projected_sql() -> str:
    """The same collections from the tables that were packed."""
    parts = []
    for collection in _COLLECTIONS:
        tables, columns = packages.COLLECTIONS[collection]
        for table in tables:
            source, cells = _PACKED[table]
            of = {c: e for c, _, e in cells}
            made = []
            for name, column, kind in columns:
                text = f"({of[column]})::varchar" if column in of else "null::varchar"
                made.append({"text": text, "unknown": text, "integer": f"try_cast({text} as bigint)", "truth": f"lower(trim({text})) in ('true', '1', 'yes')"}[kind] + f' as "{name}"')
            parts.append(f"select '{collection}' as collection, '{table}' as source_table, {', '.join(made)} from {source}")
    return " union all by name ".join(parts)


@_query("legacy_projections", _projected_sql())
def _projected(spark, d):
    """Every row of six tables goes through packages, their declared schema and the compiled mapping."""

    def cells(column: str, e: str) -> list[Column]:
        return [F.lit(column), F.expr(e).cast("string")]

    def packed(table: str) -> DataFrame:
        source, columns = _PACKED[table]
        pairs = [x for c, _, e in columns for x in cells(c, e)]
        return _read(spark, d, source).select(F.lit(table).alias("table"), F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("cells"))

    folder = new_folder(spark, "packages")
    rows = reduce(DataFrame.unionByName, (packed(t) for t in _PACKED))
    packages.write_packages(rows, folder, {t: [(c, kind, True) for c, kind, _ in columns] for t, (_, columns) in _PACKED.items()})
    found = packages.project(spark, folder)
    parts = [found[c].withColumn("collection", F.lit(c)).drop("source_file") for c in _COLLECTIONS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
