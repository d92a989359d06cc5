"""Relations as queries: access rules, totals over paths, and forests, over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .functions import layout, selectors
from .operators import catalogues, forest, proposals, systems
from .queries import _query, _read, _report

# Access rules

_ACCESS = {
    "customer": {"condition": {"all": [{"field": "c_mktsegment", "operator": "notEqual", "value": "BUILDING"}, {"field": {"items": ["#nation", "#region", "#r_name"]}, "operator": "notEqual", "value": "ASIA"}]}},
    "orders": {"condition": {"field": "o_orderstatus", "operator": "notEqual", "parameter": "hidden"}},
    "lineitem": {"through": ["order"]},
}
_SEEN = (
    "with c as (select customer.* from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_mktsegment <> 'BUILDING' and r_name <> 'ASIA'), "
    "o as (select * from orders where o_orderstatus <> 'P'), l as (select lineitem.* from lineitem join o on l_orderkey = o_orderkey) "
)

_report(
    "access_on_path",
    {
        "entity": "lineitem",
        "columns": [{"field": "l_orderkey", "alias": "l_orderkey"}, {"field": "l_linenumber", "alias": "l_linenumber"}, {"field": {"items": ["#order", "#o_orderstatus"]}, "alias": "status"}, {"field": {"items": ["#order", "#customer", "#c_name"]}, "alias": "customer"}, {"field": {"items": ["#order", "#customer", "#nation", "#n_name"]}, "alias": "nation"}],
    },
    _SEEN + "select l_orderkey, l_linenumber, o_orderstatus as status, c_name as customer, n_name as nation from l left join o on l_orderkey = o_orderkey left join c on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey",
    access=_ACCESS,
    values={"hidden": "P"},
)
_report(
    "access_in_details",
    {
        "entity": "customer",
        "columns": [
            {"field": "c_custkey", "alias": "id"}, {"field": "c_mktsegment", "alias": "kind"}, {"detail": {"relation": "orders", "aggregate": "count"}, "alias": "n"},
            {"detail": {"path": ["orders", "lines"], "field": "l_quantity", "aggregate": "sum"}, "alias": "quantity"}, {"detail": {"relation": "compatriots", "aggregate": "count"}, "alias": "neighbours"},
        ],
        "condition": {"field": "c_nationkey", "operator": "inList", "value": {"report": {"entity": "customer", "columns": [{"field": "c_nationkey", "alias": "k"}], "condition": {"field": "c_acctbal", "operator": "greaterThan", "value": 9000.0}}}},
        "subReports": [{"entity": "orders", "columns": [{"field": "o_orderkey", "alias": "id"}, {"field": "o_orderstatus", "alias": "kind"}, {"detail": {"relation": "lines", "aggregate": "count"}, "alias": "n"}]}],
    },
    _SEEN + ", n as (select o_custkey, count(*) as n from o group by 1), q as (select o_custkey, sum(l_quantity) as quantity from o join l on o_orderkey = l_orderkey group by 1), "
    "m as (select c_nationkey, count(*) as neighbours from c group by 1), b as (select l_orderkey, count(*) as n from l group by 1) "
    "select c_custkey as id, c_mktsegment as kind, coalesce(n, 0) as n, quantity::double as quantity, coalesce(neighbours, 0) as neighbours from c left join n on n.o_custkey = c_custkey left join q on q.o_custkey = c_custkey left join m using (c_nationkey) "
    "where c_nationkey in (select c_nationkey from c where c_acctbal > 9000) union all select o_orderkey, o_orderstatus, coalesce(n, 0), null, null from o left join b on l_orderkey = o_orderkey",
    access=_ACCESS,
    values={"hidden": "P"},
)

# Totals over paths

_LINES = ["orders", "lines"]
_report(
    "path_totals",
    {
        "entity": "customer",
        "columns": [
            {"field": "c_custkey", "alias": "c_custkey"}, {"detail": {"path": _LINES, "aggregate": "count"}, "alias": "lines"}, {"detail": {"path": _LINES, "field": "l_extendedprice", "aggregate": "sum"}, "alias": "price"},
            {"detail": {"path": _LINES, "field": "l_quantity", "aggregate": "avg"}, "alias": "mean"}, {"detail": {"path": _LINES, "field": {"items": ["#part", "#p_size"]}, "aggregate": "max"}, "alias": "size"},
            {"detail": {"path": ["orders"], "field": "o_totalprice", "aggregate": "sum"}, "alias": "total"},
            {"detail": {"path": [{"relation": "orders", "condition": {"field": "o_orderstatus", "operator": "equal", "value": "F"}}, {"relation": "lines", "condition": {"field": "l_returnflag", "operator": "equal", "value": "R"}}], "aggregate": "exists"}, "alias": "returned"},
        ],
    },
    "with l as (select o_custkey, count(*) as lines, sum(l_extendedprice::decimal(28,4))::double as price, sum(l_quantity::decimal(28,4))::double / count(l_quantity) as mean, max(p_size) as size, "
    "bool_or(o_orderstatus = 'F' and l_returnflag = 'R') as returned from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey group by 1), "
    "t as (select o_custkey, sum(o_totalprice::decimal(28,4))::double as total from orders group by 1) "
    "select c_custkey, coalesce(lines, 0) as lines, price, mean, size, total, coalesce(returned, false) as returned from customer left join l on l.o_custkey = c_custkey left join t on t.o_custkey = c_custkey",
)
_report(
    "path_totals_by_group",
    {
        "entity": "customer",
        "columns": [
            {"field": {"items": ["#nation", "#n_name"]}, "alias": "nation"}, {"aggregate": "count", "alias": "customers"}, {"detail": {"path": _LINES, "aggregate": "count"}, "alias": "lines"},
            {"detail": {"path": _LINES, "field": "l_quantity", "aggregate": "avg"}, "alias": "mean"}, {"detail": {"path": _LINES, "field": "l_shipdate", "aggregate": "min"}, "alias": "first"},
            {"detail": {"path": ["nation", "suppliers"], "field": "s_acctbal", "aggregate": "max"}, "alias": "richest"}, {"field": "c_acctbal", "aggregate": "sum", "alias": "balance"},
        ],
        "sqlGrouping": ["nation"],
        "sorting": [{"alias": "nation"}],
    },
    "with l as (select c_nationkey, count(*) as lines, sum(l_quantity::decimal(28,4))::double / count(l_quantity) as mean, min(l_shipdate) as first from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey group by 1), "
    "s as (select s_nationkey, max(s_acctbal) as richest from supplier group by 1), c as (select c_nationkey, count(*) as customers, sum(c_acctbal::decimal(28,4))::double as balance from customer group by 1) "
    "select n_name as nation, customers, coalesce(lines, 0) as lines, mean, first, richest, balance from c join nation on c_nationkey = n_nationkey left join l using (c_nationkey) left join s on s_nationkey = c_nationkey",
)

# Forests


def _tree(spark, d):
    line = _read(spark, d, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("key"), "l_orderkey").distinct()  # a line's key repeats
    return forest.forest([("customer", _read(spark, d, "customer"), "c_custkey", None, None), ("orders", _read(spark, d, "orders"), "o_orderkey", "customer", "o_custkey"), ("lineitem", line, "key", "orders", "l_orderkey")])


_TREE = (
    "select 'customer:' || c_custkey as id, null as parent, 'customer' as kind from customer union all select 'orders:' || o_orderkey, 'customer:' || o_custkey, 'orders' from orders "
    "union all select distinct 'lineitem:' || l_orderkey || '/' || l_linenumber, 'orders:' || l_orderkey, 'lineitem' from lineitem"
)


@_query(
    "tree_descendants",
    "select 'customer:' || o_custkey as ancestor, 'orders:' || o_orderkey as id, 1 as levels from orders union all select distinct 'orders:' || l_orderkey, 'lineitem:' || l_orderkey || '/' || l_linenumber, 1 from lineitem "
    "union all select distinct 'customer:' || o_custkey, 'lineitem:' || l_orderkey || '/' || l_linenumber, 2 from lineitem join orders on l_orderkey = o_orderkey",
)
def _descendants(spark, d):
    nodes = _tree(spark, d)
    placed, _ = forest.labels(nodes)
    return forest.descendants(placed, nodes.select("id"))


@_query(
    "tree_intervals",
    f"with recursive t as ({_TREE}), b as (select id, null::varchar as parent, id as root, 0 as depth, [id] as path from t where parent is null union all select t.id, t.parent, b.root, b.depth + 1, list_append(b.path, t.id) from t join b on t.parent = b.id), "
    "n as (select *, row_number() over (order by path) - 1 as first from b), s as (select id, count(*) as size from (select unnest(path) as id from b) group by id) "
    "select id, parent, root, depth::bigint as depth, first, first + size - 1 as last from n join s using (id)",
)
def _intervals(spark, d):
    return forest.labels(_tree(spark, d))[0]


@_query(
    "tree_totals",
    "with l as (select l_orderkey, 'lineitem:' || l_orderkey || '/' || l_linenumber as id, sum(l_quantity::bigint)::bigint as q from lineitem group by 1, 2), o as (select o_custkey, o_orderkey, coalesce(sum(q), 0)::bigint as q, count(q) as n from orders left join l on l_orderkey = o_orderkey group by 1, 2), "
    "c as (select c_custkey, coalesce(sum(q), 0)::bigint as q, count(q) + coalesce(sum(n), 0)::bigint as n from customer left join o on o_custkey = c_custkey group by 1) "
    "select id, q as total, 1::bigint as rows from l union all select 'orders:' || o_orderkey, q, n + 1 from o union all select 'customer:' || c_custkey, q, n + 1 from c",
)
def _totals(spark, d):
    placed, _ = forest.labels(_tree(spark, d))
    own = _read(spark, d, "lineitem").select(F.concat(F.lit("lineitem:"), F.concat_ws("/", "l_orderkey", "l_linenumber")).alias("id"), F.col("l_quantity").cast("long").alias("q"))
    return forest.subtree_totals(placed, own, "id", "q")

# Systems: regions are systems, nations their entities, a forest of parts their folders


def _model_rows(spark, d):
    read = lambda name: _read(spark, d, name)
    of = lambda name, collection, key, **more: read(name).select(F.lit(collection).alias("collection"), F.col(key).cast("string").alias("id"), *(F.expr(e).cast("string").alias(c) for c, e in more.items()))
    return [
        of("nation", "entities", "n_nationkey", _ownerId="null"), of("customer", "fields", "c_custkey", entityId="case when c_custkey % 3 > 0 then c_nationkey end", _ownerId="c_nationkey + 1"),
        of("supplier", "relationDefs", "s_suppkey", sourceEntity="s_nationkey", targetEntity="s_suppkey % 30"), of("part", "navigation", "p_partkey"),
        of("orders", "code", "o_orderkey", targetObjectId="case o_orderstatus when 'P' then null else o_custkey % 26 end", _ownerId="o_orderkey % 7"),
        of("lineitem", "views", "l_orderkey", systemId="case when l_returnflag = 'R' then l_linenumber end", entityId="l_suppkey % 25"),
    ]


@_query(
    "system_assignment",
    "with recursive e as (select n_nationkey as id, n_regionkey as s from nation where n_nationkey % 6 > 0), p as (select p_partkey as id, case when p_partkey < 8 then null else p_partkey // 8 end as up from part), "
    "top as (select id, id as root from p where up is null or up not in (select id from p) union all select p.id, root from p join top on p.up = top.id), "
    "r as (select 'entities' as collection, n_nationkey as id, 'entity' as rule, [n_nationkey] as keys from nation "
    "union all select 'fields', c_custkey, 'owner', [case when c_custkey % 3 > 0 then c_nationkey else c_nationkey + 1 end] from customer "
    "union all select 'relationDefs', s_suppkey, 'ends', [s_nationkey, s_suppkey % 30] from supplier "
    "union all select 'code', o_orderkey, 'target', [case when o_orderstatus = 'P' then o_orderkey % 7 else o_custkey % 26 end] from orders "
    "union all select 'views', l_orderkey, 'owner', [l_suppkey % 25] from lineitem where l_returnflag <> 'R'), "
    "a as (select collection, id, rule, list_sort(list_distinct((select list(s) from e where list_contains(keys, e.id)))) as s from r "
    "union all select 'views', l_orderkey, 'own', case when l_linenumber < 5 then [l_linenumber] else null end from lineitem where l_returnflag = 'R' "
    "union all select 'navigation', id, 'folder', case when root between 1 and 5 then [root - 1] else null end from top) "
    "select collection, id::varchar as id, case when len(s) > 0 then rule end as rule, coalesce(array_to_string(s, ','), '') as systems, case when s is null or len(s) = 0 then 'unassigned' when len(s) = 1 then 'assigned' else 'shared' end as state from a",
)
def _assignment(spark, d):
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _model_rows(spark, d))
    known = _read(spark, d, "region").select(F.col("r_regionkey").alias("id"), (F.col("r_regionkey") + 1).alias("rootFolderId"))
    entities = _read(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 6 > 0, F.col("n_regionkey")).alias("systemId"))
    folders = _read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr("case when p_partkey < 8 then null else p_partkey div 8 end").alias("parentId"))
    out = systems.assigned(rows, known, entities, folders)
    return out.select("collection", "id", "rule", F.array_join("systems", ",").alias("systems"), "state")


# Catalogues of tables, and proposals


@_query(
    "table_catalogue",
    "with u as (select 'T' || l_partkey % 40 as t, l_returnflag || l_linenumber as place from lineitem), d as (select distinct 'T' || p_size as t from part), g as (select t, list_sort(list(distinct place)) as places from u group by 1) "
    "select coalesce(d.t, g.t) as \"table\", coalesce(array_to_string(places, ','), '') as places, d.t is not null as declared, case when d.t is not null and g.t is not null then 'CrossVerified' else 'Verified' end as confidence from d full join g on d.t = g.t",
)
def _tables(spark, d):
    used = _read(spark, d, "lineitem").select(F.concat(F.lit("T"), (F.col("l_partkey") % 40).cast("string")).alias("table"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("place"))
    declared = _read(spark, d, "part").select(F.concat(F.lit("T"), F.col("p_size").cast("string")).alias("table"))
    return catalogues.table_catalogue(declared, used).withColumn("places", F.array_join("places", ","))


@_query(
    "proposal_findings",
    "with p as (select *, o_custkey % 30 as sys, o_orderkey % 5 as kind from orders), s as (select n_nationkey as system, n_regionkey > 0 as allowed, n_regionkey < 4 as indexed from nation) "
    "select o_orderkey, '$.proposal.scope.allow[0]' as place, 'selector' as rule, o_orderpriority as detail from p where kind in (0, 1) "
    "union all select o_orderkey, '$.proposal.scope.allow[0]', 'objectType', 'thing' from p where kind = 1 union all select o_orderkey, '$.proposal.scope', 'required', 'allow' from p where kind = 2 "
    "union all select o_orderkey, '$.proposal.scope.allow', 'minItems', '1, it has 0' from p where kind = 3 union all select o_orderkey, '$.proposal.gates[1]', 'enum', o_orderstatus from p "
    "union all select o_orderkey, '$.proposal.system', 'systemNotAllowed', sys::varchar from p left join s on sys = system where not coalesce(allowed, false) union all select o_orderkey, '$.proposal.system', 'systemNotIndexed', sys::varchar from p left join s on sys = system where not coalesce(indexed, false)",
)
def _proposals(spark, d):
    o = _read(spark, d, "orders")
    kind, text = F.col("o_orderkey") % 5, lambda c: F.to_json(F.array(c))
    entry = lambda t, c: text(F.concat(F.lit(f"{t}:"), c))
    allow = F.when(kind == 0, entry("report", F.col("o_orderpriority"))).when(kind == 1, entry("thing", F.col("o_orderpriority"))).when(kind == 3, "[]").otherwise('["report:#X", "field:*"]')
    scope = F.when(kind == 2, "{}").otherwise(F.concat(F.lit('{"allow": '), allow, F.lit("}")))
    doc = F.concat(F.lit('{"proposal": {"scope": '), scope, F.lit(', "gates": ["lint", "'), F.col("o_orderstatus"), F.lit('"], "system": '), (F.col("o_custkey") % 30).cast("string"), F.lit("}}"))
    types = _read(spark, d, "part").select(F.when(F.col("p_partkey") % 2 == 0, "report").otherwise("field").alias("objectType"))
    known = _read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("system"), (F.col("n_regionkey") > 0).alias("allowed"), (F.col("n_regionkey") < 4).alias("indexed"))
    return proposals.proposal_findings(o.select("o_orderkey", doc.alias("doc")), "o_orderkey", "doc", types, known)


@_query(
    "evidence_findings",
    "with t as (select doc_id, lang, unnest(list_distinct(regexp_extract_all(coalesce(text, '') || ' AC-' || n_chars || ', AC-9', 'AC-[0-9]+'))) as ac from documents) "
    "select doc_id, '$.evidence.acceptance' as place, 'uncovered' as rule, ac as detail from t where ac <> 'AC-9' "
    "union all select doc_id, '$.evidence.acceptance[0].verdict', case lang when 'en' then 'not' else 'enum' end, case lang when 'en' then 'what is ruled out fits' else lang end from documents where lang <> 'de' "
    "union all select doc_id, '$.evidence.acceptance[0]', 'required', 'basis' from documents where n_chars > 2000",
)
def _evidence(spark, d):
    docs = _read(spark, d, "documents")
    verdict = F.when(F.col("lang") == "en", "fail").when(F.col("lang") == "de", "pass").otherwise(F.col("lang"))
    basis = F.when(F.col("n_chars") > 2000, "").otherwise(', "basis": "seen"')
    results = docs.select("doc_id", F.concat(F.lit('{"evidence": {"acceptance": [{"ac": "AC-9", "verdict": "'), verdict, F.lit('"'), basis, F.lit("}]}}")).alias("doc"))
    tasks = docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" AC-"), F.col("n_chars").cast("string"), F.lit(", AC-9")).alias("text"))
    return proposals.evidence_findings(results, "doc_id", "doc", tasks, "text")


# Selectors, panels and roles


@_query(
    "selector_codec",
    "select p_partkey, '#[' || replace(p_brand, '#', '\\#') || '|' || p_type || ']' || replace(p_name, ' ', '|') || '|' || '\\@\\[x\\]\\\\' as selector, 'selector' as kind, p_brand || '+' || p_type as target, replace(p_name, ' ', '+') || '+@[x]\\' as key from part "
    "union all select p_partkey, repeat('#', p_size % 4) || p_name, case when p_size % 2 = 1 then 'selector' else 'literal' end, null, case when p_size % 2 = 1 then repeat('#', (p_size % 4) // 2) || p_name else repeat('#', (p_size % 4) // 2) || p_name end from part",
)
def _codec(spark, d):
    p = _read(spark, d, "part")
    one = p.select("p_partkey", selectors.encoded(F.concat(F.split("p_name", " "), F.array(F.lit("@[x]\\"))), F.array("p_brand", "p_type")).alias("selector"))
    both = one.unionByName(p.select("p_partkey", F.concat(F.repeat(F.lit("#"), F.col("p_size") % 4), F.col("p_name")).alias("selector")))
    out = both.withColumn("d", selectors.decoded(F.col("selector")))
    return out.select("p_partkey", "selector", "d.kind", F.array_join("d.target", "+").alias("target"), F.coalesce(F.array_join("d.key", "+"), F.col("d.literal")).alias("key"))


@_query(
    "panel_heights",
    "with n as (select c_custkey, count(o_orderkey) as n, c_nationkey % 4 as columns, c_acctbal > 0 as search from customer left join orders on o_custkey = c_custkey group by all) "
    "select c_custkey, n, case when columns > 0 then greatest(18 + ceil(n / columns)::bigint * 24 + case when search then 28 else 0 end, case when search then 46 else 34 end)::bigint end as height from n",
)
def _panels(spark, d):
    n = _read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    c = _read(spark, d, "customer").join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return c.select("c_custkey", "n", layout.panel_height(F.col("n"), F.col("c_nationkey") % 4, F.col("c_acctbal") > 0).alias("height"))


_report(
    "calendar_roles",
    {
        "entity": "orders",
        "columns": [{"field": "o_orderkey", "alias": "id"}],
        "calendar": {"name": {"items": ["#customer", "#c_name"]}, "startDate": "o_orderdate", "ownerId": {"items": ["#customer", "#nation", "#n_name"]}, "color": "id"},
        "condition": {"field": "o_orderstatus", "operator": "equal", "value": "P"},
    },
    "select o_orderkey as id, c_name as \"calendar:name\", o_orderdate as \"calendar:startDate\", n_name as \"calendar:ownerId\" from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey where o_orderstatus = 'P'",
)
