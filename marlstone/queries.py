"""Every operator as a query over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import testdata
from .functions import text as t
from .functions.dates import RUNTIME_DATES, date_range
from .operators import audit, batch, catalogues, evidence, forest, hierarchy, jsonwalk, match, merge, retrieve
from .plans.compile import compile_report
from .plans.conditions import Bindings
from .sources import documents as docsrc
from .sources import formats, sinks
from .streaming import windows, workflow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = datetime(2024, 1, 15, 10, 30)
M = "decimal(28,4)"


def _report(name: str, spec: dict, sql: str, **bind) -> None:
    QUERIES[name] = lambda spark, d: compile_report(testdata(spark, d), spec, Bindings(**{"as_of": AS_OF, **bind}))
    SQL[name] = sql


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Conditions: one query an operator

_PART = [{"field": "p_partkey", "alias": "p_partkey"}, {"field": "p_name", "alias": "p_name"}]
_ORDER = [{"field": "o_orderkey", "alias": "o_orderkey"}, {"field": "o_orderpriority", "alias": "priority"}]
_LINE = [{"field": "l_orderkey", "alias": "l_orderkey"}, {"field": "l_linenumber", "alias": "l_linenumber"}, {"field": "l_quantity", "alias": "qty"}]
for _name, _entity, _cols, _leaf, _where in [
    ("none", "part", _PART, {"operator": "none"}, "true"),
    ("equal", "orders", _ORDER, {"field": "o_orderstatus", "operator": "equal", "value": "F"}, "o_orderstatus = 'F'"),
    ("not_equal", "orders", _ORDER, {"field": "o_orderstatus", "operator": "notEqual", "value": "F"}, "o_orderstatus <> 'F'"),
    ("greater_than", "lineitem", _LINE, {"field": "l_quantity", "operator": "greaterThan", "value": 40.0}, "l_quantity > 40"),
    ("less_than", "lineitem", _LINE, {"field": "l_quantity", "operator": "lessThan", "value": 5.0}, "l_quantity < 5"),
    ("greater_or_equal", "lineitem", _LINE, {"field": "l_quantity", "operator": "greaterThanOrEqual", "value": 49.0}, "l_quantity >= 49"),
    ("less_or_equal", "lineitem", _LINE, {"field": "l_quantity", "operator": "lessThanOrEqual", "value": 2.0}, "l_quantity <= 2"),
    ("contains", "part", _PART, {"field": "p_type", "operator": "contains", "value": "a", "ignoreCase": True}, "contains(lower(p_type), 'a')"),
    ("not_contains", "part", _PART, {"field": "p_type", "operator": "doesNotContain", "value": "A"}, "not contains(p_type, 'A')"),
    ("starts_with", "part", _PART, {"field": "p_brand", "operator": "startsWith", "value": "Brand#1"}, "starts_with(p_brand, 'Brand#1')"),
    ("not_starts_with", "part", _PART, {"field": "p_brand", "operator": "doesNotStartWith", "value": "Brand#1"}, "not starts_with(p_brand, 'Brand#1')"),
    ("is_null", "documents", [{"field": "doc_id", "alias": "doc_id"}], {"field": {"items": ["#label", "#quality"]}, "operator": "isNull"}, "doc_id not in (select doc_id from labels)"),
    ("is_not_null", "documents", [{"field": "doc_id", "alias": "doc_id"}], {"field": {"items": ["#label", "#quality"]}, "operator": "isNotNull"}, "doc_id in (select doc_id from labels)"),
    ("between", "part", _PART, {"field": "p_size", "operator": "between", "value": [10, 20]}, "p_size between 10 and 20"),
    ("in_list", "orders", _ORDER, {"field": "o_orderstatus", "operator": "inList", "value": ["O", "P"]}, "o_orderstatus in ('O', 'P')"),
    ("not_in_list", "orders", _ORDER, {"field": "o_orderstatus", "operator": "notInList", "value": ["O", "P"]}, "o_orderstatus not in ('O', 'P')"),
]:
    _select = ", ".join(f"{c['field']} as {c['alias']}" for c in _cols)
    _report(f"cond_{_name}", {"entity": _entity, "columns": _cols, "condition": {"all": [_leaf]}}, f"select {_select} from {_entity} where {_where}")

_report(
    "cond_text_search_all",
    {"entity": "part", "columns": _PART, "condition": {"field": "p_name", "operator": "advancedTextSearch", "value": "Bolt blue"}},
    "select p_partkey, p_name from part where list_has_all(string_split_regex(lower(p_name), '\\s+'), ['bolt', 'blue'])",
    allow_text_search=True,
)
_report(
    "cond_tree",
    {
        "entity": "orders",
        "columns": _ORDER,
        "condition": {"any": [{"all": [{"field": "o_orderstatus", "operator": "equal", "value": "F"}, {"field": "o_totalprice", "operator": "greaterThan", "value": 300000.0}]}, {"all": [{"field": "o_orderstatus", "operator": "equal", "value": "O"}, {"field": "o_totalprice", "operator": "lessThan", "value": 5000.0}]}]},
    },
    "select o_orderkey, o_orderpriority as priority from orders where (o_orderstatus = 'F' and o_totalprice > 300000) or (o_orderstatus = 'O' and o_totalprice < 5000)",
)
_report("cond_disabled", {"entity": "orders", "columns": _ORDER, "condition": {"all": [{"field": "o_orderstatus", "operator": "equal", "value": "F", "enabled": False}]}}, "select o_orderkey, o_orderpriority as priority from orders")
_report("cond_field_to_field", {"entity": "lineitem", "columns": _LINE, "condition": {"field": "l_discount", "operator": "greaterThan", "valueField": "l_tax"}}, "select l_orderkey, l_linenumber, l_quantity as qty from lineitem where l_discount > l_tax")
_report(
    "cond_custom_sql",
    {"entity": "orders", "columns": _ORDER, "condition": {"customSql": "DATEDIFF(day, o_orderdate, GETDATE()) < 10000 and ISNULL(o_orderstatus, '') = 'P'", "operator": "none", "enabled": True}},
    "select o_orderkey, o_orderpriority as priority from orders where date_diff('day', o_orderdate, timestamp '2024-01-15 10:30:00') < 10000 and coalesce(o_orderstatus, '') = 'P'",
)
_report(
    "join_aliases",
    {
        "entity": "lineitem",
        "joinAliases": [{"id": 1, "name": "buyer", "field": {"items": ["#order", "#customer"]}}, {"id": 2, "name": "maker", "field": "supplier"}],
        "columns": [*_LINE, {"field": {"items": ["buyer", "nation", "n_name"]}, "alias": "buyer_nation"}, {"field": {"items": ["maker", "nation", "n_name"]}, "alias": "maker_nation"}],
        "condition": {"field": {"items": ["buyer", "c_acctbal"]}, "operator": "lessThan", "value": 0.0},
    },
    "select l_orderkey, l_linenumber, l_quantity as qty, b.n_name as buyer_nation, m.n_name as maker_nation from lineitem join orders on l_orderkey = o_orderkey "
    "join customer on o_custkey = c_custkey join nation b on c_nationkey = b.n_nationkey join supplier on l_suppkey = s_suppkey join nation m on s_nationkey = m.n_nationkey where c_acctbal < 0",
)
_report(
    "external_parameter",
    {
        "entity": "orders",
        "columns": _ORDER,
        "parameters": [{"name": "Id", "external": True}, {"name": "Status", "external": True}],
        "condition": {"all": [{"field": "o_custkey", "operator": "equal", "parameter": "Id"}, {"field": "o_orderstatus", "operator": "notEqual", "parameter": "Status"}]},
    },
    "select o_orderkey, o_orderpriority as priority from orders where o_custkey = 7 and o_orderstatus <> 'F'",
    parent={"Id": 7, "Status": "F"},
)
_report(
    "exclude_self",
    {
        "entity": "customer",
        "columns": [
            {"field": "c_custkey", "alias": "c_custkey"},
            {"alias": "others_in_debt", "detail": {"relation": "compatriots", "aggregate": "count", "field": "c_custkey", "condition": {"field": "c_acctbal", "operator": "lessThan", "value": 0.0}, "excludeSelf": True}},
        ],
    },
    "select c.c_custkey, (select count(*) from customer o where o.c_nationkey = c.c_nationkey and o.c_custkey <> c.c_custkey and o.c_acctbal < 0) as others_in_debt from customer c",
)
_report(
    "report_in_any",
    {
        "entity": "orders",
        "columns": _ORDER,
        "condition": {"any": [
            {"field": "o_totalprice", "operator": "lessThan", "value": 2000.0},
            {"all": [{"field": "o_custkey", "operator": "inList", "value": {"report": {"entity": "customer", "columns": [{"field": "c_custkey", "alias": "k"}], "condition": {"field": "c_acctbal", "operator": "lessThan", "value": -900.0}}}}, {"field": "o_orderstatus", "operator": "equal", "value": "O"}]},
        ]},
    },
    "select o_orderkey, o_orderpriority as priority from orders where o_totalprice < 2000 or (o_custkey in (select c_custkey from customer where c_acctbal < -900) and o_orderstatus = 'O')",
)
for _behave, _where in [("ignore", "true"), ("check", "l.quality is null"), ("dont", "false")]:
    _report(
        f"null_behavior_{_behave}",
        {
            "entity": "documents",
            "columns": [{"field": "doc_id", "alias": "doc_id"}, {"field": {"items": ["#label", "quality"]}, "alias": "quality"}],
            "parameters": [{"name": "q", "value": None}],
            "condition": {"field": {"path": ["label", "quality"]}, "operator": "equal", "parameter": "q", "nullBehavior": {"ignore": "ignoreCondition", "check": "checkNullValue", "dont": "dontIgnore"}[_behave]},
        },
        f"select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id where {_where}",
    )
_MOMENTS = {"previousMonth": datetime(2024, 2, 10), "nextMonth": datetime(2023, 12, 10), "previousYear": datetime(2025, 3, 5), "nextYear": datetime(2023, 6, 7)}
for _kind in RUNTIME_DATES:
    # events are of one month: a moment from which the kind means it
    _moment = _MOMENTS.get(_kind, AS_OF)
    _a, _b = (f"timestamp '{x:%Y-%m-%d %H:%M:%S}'" for x in date_range(_kind, _moment))
    _where = f"ts >= {_a} and ts < {_b}" if _kind != "now" else f"ts <= {_a}"
    _op = "lessThanOrEqual" if _kind == "now" else "equal"
    _report(
        f"date_range_{_kind}",
        {"entity": "events", "columns": [{"field": "event_id", "alias": "event_id"}, {"field": "event_type", "alias": "event_type"}], "parameters": [{"name": "when", "contextValue": _kind}], "condition": {"field": "ts", "operator": _op, "parameter": "when"}},
        f"select event_id, event_type from events where {_where}",
        as_of=_moment,
    )
_report(
    "current_user",
    {"entity": "events", "columns": [{"field": "event_id", "alias": "event_id"}], "parameters": [{"name": "me", "contextValue": "currentUser"}], "condition": {"field": "user_id", "operator": "equal", "parameter": "me"}},
    "select event_id from events where user_id = 7",
    current_user=7,
)
_report(
    "in_report",
    {"entity": "customer", "columns": [{"field": {"self": True}, "alias": "id"}], "condition": {"all": [{"field": "c_custkey", "operator": "inList", "value": {"report": {"entity": "orders", "columns": [{"field": "o_custkey", "alias": "k"}], "condition": {"field": "o_totalprice", "operator": "greaterThan", "value": 350000.0}}}}]}},
    "select c_custkey as id from customer where c_custkey in (select o_custkey from orders where o_totalprice > 350000)",
)
_report(
    "not_in_report",
    {"entity": "customer", "columns": [{"field": {"self": True}, "alias": "id"}], "condition": {"all": [{"field": "c_custkey", "operator": "notInList", "value": {"report": {"entity": "orders", "columns": [{"field": "o_custkey", "alias": "k"}], "condition": {"field": "o_totalprice", "operator": "greaterThan", "value": 200000.0}}}}]}},
    "select c_custkey as id from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000)",
)

# Relation paths

_FLAGSHIP = {
    "entity": "lineitem",
    "columns": [{"field": {"items": ["#order", "#customer", "#nation", "#n_name"]}, "alias": "nation"}, {"field": "l_extendedprice", "alias": "revenue", "aggregate": "sum"}, {"aggregate": "count", "alias": "n_lines"}],
    "condition": {"all": [{"field": "l_quantity", "operator": "greaterThan", "value": 40.0}, {"field": {"items": ["#order", "#customer", "#nation", "#region", "#r_name"]}, "operator": "inList", "value": ["ASIA", "EUROPE", "AMERICA"]}]},
    "sqlGrouping": ["nation"],
    "sorting": [{"alias": "revenue", "direction": "desc"}, {"alias": "nation"}],
    "top": 10,
}
_PATH_FROM = "from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"
_report(
    "path_join_4hop",
    _FLAGSHIP,
    f"select n_name as nation, sum(cast(l_extendedprice as {M}))::double as revenue, count(*) as n_lines {_PATH_FROM} where l_quantity > 40 and r_name in ('ASIA', 'EUROPE', 'AMERICA') group by 1 order by 2 desc, 1 limit 10",
)
_report(
    "path_shared_prefix",
    {
        "entity": "lineitem",
        "columns": [{"field": {"items": ["order", "customer", "c_mktsegment"]}, "alias": "segment"}, {"field": {"items": ["order", "o_orderstatus"]}, "alias": "status"}, {"aggregate": "count", "alias": "n"}],
        "sqlGrouping": ["segment", "status"],
    },
    f"select c_mktsegment as segment, o_orderstatus as status, count(*) as n {_PATH_FROM} group by 1, 2",
)
_report(
    "path_reverse",
    {"entity": "nation", "columns": [{"field": "n_name", "alias": "nation"}, {"field": {"items": ["#suppliers", "#s_name"]}, "alias": "supplier"}]},
    "select n_name as nation, s_name as supplier from nation left join supplier on s_nationkey = n_nationkey",
)
_report(
    "path_two_instances",
    {
        "entity": "lineitem",
        "columns": [{"field": {"items": ["supplier", "nation", "n_name"]}, "alias": "from_nation"}, {"field": {"items": ["order", "customer", "nation", "n_name"]}, "alias": "to_nation"}, {"aggregate": "count", "alias": "n"}],
        "sqlGrouping": ["from_nation", "to_nation"],
    },
    "select a.n_name as from_nation, b.n_name as to_nation, count(*) as n from lineitem left join supplier on l_suppkey = s_suppkey left join nation a on s_nationkey = a.n_nationkey left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation b on c_nationkey = b.n_nationkey group by 1, 2",
)

# Aggregates

for _agg, _spec, _sql in [
    ("count", {"aggregate": "count", "field": "o_orderkey"}, "count(o_orderkey)"),
    ("sum", {"aggregate": "sum", "field": "o_totalprice"}, f"sum(cast(o_totalprice as {M}))::double"),
    ("min", {"aggregate": "min", "field": "o_totalprice"}, "min(o_totalprice)"),
    ("max", {"aggregate": "max", "field": "o_totalprice"}, "max(o_totalprice)"),
    ("avg", {"aggregate": "avg", "field": "o_totalprice"}, f"sum(cast(o_totalprice as {M}))::double / count(o_totalprice)"),
    ("first", {"aggregate": "first", "field": "o_totalprice", "orderBy": "o_orderkey"}, "min_by(o_totalprice, o_orderkey)"),
    ("string_concat", {"aggregate": "stringConcat", "field": "o_orderkey", "separator": ";"}, "string_agg(o_orderkey::varchar, ';' order by o_orderkey)"),
    ("exists", {"aggregate": "exists", "field": "o_totalprice"}, "count(o_totalprice) > 0"),
    ("not_exists", {"aggregate": "notExists", "field": "o_totalprice"}, "count(o_totalprice) = 0"),
    ("custom", {"aggregate": "custom", "customSql": "max(o_orderkey) - min(o_orderkey)"}, "max(o_orderkey) - min(o_orderkey)"),
]:
    _report(f"agg_{_agg}", {"entity": "orders", "columns": [{"field": "o_custkey", "alias": "customer"}, {**_spec, "alias": "v"}], "sqlGrouping": ["customer"]}, f"select o_custkey as customer, {_sql} as v from orders group by 1")
_report(
    "detail_totals",
    {
        "entity": "customer",
        "columns": [
            {"field": "c_custkey", "alias": "id"},
            {"alias": "total", "detail": {"relation": "orders", "aggregate": "sum", "field": "o_totalprice"}},
            {"alias": "open", "detail": {"relation": "orders", "aggregate": "count", "field": "o_orderkey", "condition": {"field": "o_orderstatus", "operator": "equal", "value": "O"}}},
            {"alias": "never", "detail": {"relation": "orders", "aggregate": "notExists", "field": "o_orderkey"}},
        ],
    },
    f"select c_custkey as id, sum(cast(o_totalprice as {M}))::double as total, count(*) filter (o_orderstatus = 'O') as open, count(o_orderkey) = 0 as never from customer left join orders on o_custkey = c_custkey group by 1",
)

# Clauses

_report(
    "matrix",
    {"entity": "lineitem", "matrix": {"vertical": "l_returnflag", "horizontal": "l_linestatus", "value": "l_quantity", "aggregate": "sum", "alias": "flag", "values": ["F", "O"]}},
    f"select l_returnflag as flag, sum(case when l_linestatus = 'F' then cast(l_quantity as {M}) end)::double as F, sum(case when l_linestatus = 'O' then cast(l_quantity as {M}) end)::double as O from lineitem group by 1",
)
_report(
    "summary_row",
    {"entity": "lineitem", "columns": [{"field": "l_returnflag", "alias": "flag"}, {"field": "l_quantity", "aggregate": "sum", "alias": "qty"}], "sqlGrouping": ["flag"], "useSummaryRow": True},
    f"select l_returnflag as flag, sum(cast(l_quantity as {M}))::double as qty, grouping(l_returnflag) = 1 as is_summary from lineitem group by rollup (l_returnflag)",
)
_report("distinct_top", {"entity": "lineitem", "columns": [{"field": "l_suppkey", "alias": "s"}, {"field": "l_returnflag", "alias": "f"}], "isDistinct": True, "sorting": [{"alias": "s", "direction": "desc"}, {"alias": "f"}], "top": 25}, "select distinct l_suppkey as s, l_returnflag as f from lineitem order by 1 desc, 2 limit 25")
_report(
    "union_reports",
    {"entity": "customer", "columns": [{"field": "c_name", "alias": "name"}, {"field": "c_nationkey", "alias": "nation"}], "subReports": [{"entity": "supplier", "columns": [{"field": "s_name", "alias": "name"}, {"field": "s_nationkey", "alias": "nation"}]}]},
    "select c_name as name, c_nationkey as nation from customer union all select s_name, s_nationkey from supplier",
)
_report("paged", {"entity": "orders", "columns": _ORDER, "sorting": [{"alias": "o_orderkey"}], "pageSize": 20, "pageIndex": 3}, "select o_orderkey, o_orderpriority as priority from orders order by 1 limit 20 offset 60")
_report("row_number", {"entity": "orders", "columns": [*_ORDER, {"field": "o_totalprice", "alias": "p"}], "sorting": [{"alias": "p", "direction": "desc"}, {"alias": "o_orderkey"}], "showRowNumber": True}, "select o_orderkey, o_orderpriority as priority, o_totalprice as p, row_number() over (order by o_totalprice desc, o_orderkey) as row_number from orders")
_report(
    "format_conditions",
    {"entity": "part", "columns": [*_PART, {"field": "p_size", "alias": "size"}], "formatConditions": [{"name": "big", "style": "red", "condition": {"field": "size", "operator": "greaterThan", "value": 40}}]},
    "select p_partkey, p_name, p_size as size, case when p_size > 40 then 'red' end as \"format:big\" from part",
)
_report(
    "formula_column",
    {"entity": "lineitem", "columns": [{"field": "l_orderkey", "alias": "k"}, {"field": "l_linenumber", "alias": "l"}, {"formula": "{Price} * (1 - {Discount}) + {Order}.{Total} / 2", "alias": "v"}]},
    "select l_orderkey as k, l_linenumber as l, l_extendedprice * (1 - l_discount) + o_totalprice / 2 as v from lineitem left join orders on l_orderkey = o_orderkey",
)
_report(
    "case_column",
    {"entity": "orders", "columns": [{"field": "o_orderkey", "alias": "k"}, {"alias": "band", "cases": [{"when": {"field": "o_totalprice", "operator": "lessThan", "value": 50000.0}, "then": "low"}, {"when": {"field": "o_totalprice", "operator": "lessThan", "value": 200000.0}, "then": "mid"}, {"else": "high"}]}]},
    "select o_orderkey as k, case when o_totalprice < 50000 then 'low' when o_totalprice < 200000 then 'mid' else 'high' end as band from orders",
)
_report("hidden_column", {"entity": "orders", "columns": [{"field": "o_orderkey", "alias": "k"}, {"field": "o_totalprice", "alias": "p", "visible": False}], "sorting": [{"alias": "p", "direction": "desc"}, {"alias": "k"}], "top": 5}, "select o_orderkey as k from orders order by o_totalprice desc, o_orderkey limit 5")

# Trees

_GEO = "select 'R' || r_regionkey as id, null as parent, r_name as name from region union all select 'N' || n_nationkey, 'R' || n_regionkey, n_name from nation union all select 'C' || c_custkey, 'N' || c_nationkey, c_name from customer"


def _geo(spark: SparkSession, d: str) -> DataFrame:
    r, n, c = (_read(spark, d, x) for x in ("region", "nation", "customer"))
    node = lambda df, p, k, up, name: df.select(F.concat(F.lit(p), k).alias("id"), up.alias("parent"), F.col(name).alias("name"))
    return node(r, "R", "r_regionkey", F.lit(None).cast("string"), "r_name").unionByName(node(n, "N", "n_nationkey", F.concat(F.lit("R"), "n_regionkey"), "n_name")).unionByName(node(c, "C", "c_custkey", F.concat(F.lit("N"), "c_nationkey"), "c_name"))


@_query("tree_levels", f"with recursive g as ({_GEO}), t as (select id, 0 as level, id as root from g where parent is null union all select g.id, t.level + 1, t.root from g join t on g.parent = t.id) select * from t")
def _tree_levels(spark, d):
    g = _geo(spark, d)
    return hierarchy.descend(g, g.where("parent is null").select("id"), "id", "parent")


@_query("folder_owners", f"with recursive g as ({_GEO}), t as (select id, id as owner from g where parent is null union all select g.id, t.owner from g join t on g.parent = t.id) select * from t")
def _folder_owners(spark, d):
    g = _geo(spark, d)
    # a nation is owned too, but the region above it wins
    owned = g.where("id like 'R%' or id like 'N%'").select("id", F.col("id").alias("owner"))
    return hierarchy.owners(g, owned, "id", "parent")[0]


@_query("path_prefixes", "with p as (select distinct string_split(regexp_replace(url, '^https?://|[?#].*$|/$', '', 'g'), '/') as a from pages), e as (select array_to_string(a[1:i], '/') as path, a[i] as name, case when i > 1 then array_to_string(a[1:i-1], '/') end as parent_path, (i - 1)::integer as level, i = len(a) as leaf from p, unnest(range(1, len(a) + 1)) u(i)) select path, name, parent_path, level, bool_or(leaf) as is_leaf from e group by all")
def _path_prefixes(spark, d):
    p = _read(spark, d, "pages").select(F.regexp_replace("url", r"^https?://|[?#].*$|/$", "").alias("path")).distinct()
    return hierarchy.path_prefixes(p, "path")


# Text

_SECRET = r"(?i)(\b(?:password|pwd|secret|apikey|api_key|token|connectionstring)\s*)=\s*[^;\s""'']+"


@_query("fold_keys", "select c_custkey, lower(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))) as match_key, lower(c_name) as search_key, lower(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))) as caption_key from customer")
def _fold_keys(spark, d):
    c = F.col("c_name")
    return _read(spark, d, "customer").select("c_custkey", t.fold_match(c).alias("match_key"), t.fold_search(c).alias("search_key"), t.fold_caption(c).alias("caption_key"))


@_query("redact_secrets", r"""select doc_id, md5(regexp_replace(coalesce(text, ''), '(?i)(\b(?:password|pwd|secret|apikey|api_key|token|connectionstring)\s*)=\s*[^;\s"'']+', '\1=***REDACTED***', 'g')) as redacted from documents""")
def _redact(spark, d):
    return _read(spark, d, "documents").select("doc_id", F.md5(t.redact(F.coalesce("text", F.lit("")))).alias("redacted"))


@_query("classify_strings", r"""select page_id, case when regexp_matches(url, '^(https?|ftp|net\.tcp|tcp)://') then 'url' else 'other' end as url_kind, 'other' as html_kind from pages""")
def _classify(spark, d):
    return _read(spark, d, "pages").select("page_id", t.classify(F.col("url")).alias("url_kind"), t.classify(F.col("html")).alias("html_kind"))


_STATEMENTS = "select p_partkey, p_size, case p_partkey % 4 when 0 then 'SELECT a FROM met_part_' || p_size || ' JOIN dbo.met_b ON x' when 1 then 'update met_c set n = ' || p_size when 2 then 'insert into met_d values (1)' else p_name end as s from part"


@_query("sql_fragments", f"select p_partkey, case p_partkey % 4 when 0 then 'SELECT' when 1 then 'UPDATE' when 2 then 'INSERT' end as operation, case p_partkey % 4 when 0 then 'dbo.met_b,met_part_' || p_size when 1 then 'met_c' when 2 then 'met_d' end as tables from ({_STATEMENTS})")
def _sql_fragments(spark, d):
    _read(spark, d, "part").createOrReplaceTempView("_marlstone_part")
    s = spark.sql(_STATEMENTS.replace(" from part", " from _marlstone_part"))
    return s.select("p_partkey", t.sql_operation(F.col("s")).alias("operation"), F.array_join(t.sql_tables(F.col("s")), ",").alias("tables"))


@_query("stamps", "select event_id, ((event_id % 90) + 1)::int as year, abs(((event_id % 90) + 1 - 5) * 12 + (event_id % 12) + 1 - 7)::int as months, 'Export' as bare from events")
def _stamps(spark, d):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    k = F.col("event_id")
    name = F.concat(F.lit("Export ("), two(k % 90 + 1), F.lit("-"), two(k % 12 + 1), F.lit("-11 20;08)"))
    base = t.stamp(F.lit("Export (05-07-11 20;08)"))
    df = _read(spark, d, "events").select("event_id", name.alias("name"))
    return df.select("event_id", t.stamp(F.col("name"))["year"].alias("year"), t.months_between_stamps(base, t.stamp(F.col("name"))).alias("months"), t.without_stamp(F.col("name")).alias("bare"))


@_query("short_names", "select page_id, case when length(url) > 30 then url[1:21] || '~' || upper(sha256(url)[1:8]) else url end as short from pages")
def _short(spark, d):
    return _read(spark, d, "pages").select("page_id", t.short_name(F.col("url"), 30).alias("short"))


@_query("record_sign", "select o_orderkey, sha256('salt' || chr(31) || 'v' || o_custkey || chr(31) || 'v' || o_orderstatus) as sign from orders")
def _sign(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", t.record_sign("salt", F.col("o_custkey"), F.col("o_orderstatus")).alias("sign"))


@_query("masked_columns", "select c_custkey, case when length(c_name) > 0 then '***REDACTED***' end as c_token, c_mktsegment from customer")
def _masked(spark, d):
    df = _read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("c_token"), "c_mktsegment")
    return df.select(*(t.masked(F.col(c), c).alias(c) for c in df.columns))


@_query("priority_score", "select p_partkey, case when p_size > 10 then 50 + 3 * (contains(lower(p_name), '1')::int + contains(lower(p_name), '2')::int) + least(floor(p_retailprice / 100)::int, 10) else 0 end::bigint as score from part")
def _priority(spark, d):
    return _read(spark, d, "part").select("p_partkey", t.priority_score(F.col("p_size") > 10, F.col("p_name"), F.col("p_retailprice"), ["1", "2"]).alias("score"))


# JSON

@_query("json_paths", "with v as (select event_id, ts, props from events) select '$' as path, 'object' as types, count(*) as occurrences, false as nullable, min(event_id) as first_id from v union all select '$.k', 'number', count(*), false, min(event_id) from v where json_extract(props, '$.k') is not null")
def _json_paths(spark, d):
    return jsonwalk.path_catalogue(jsonwalk.walk(_read(spark, d, "events"), "event_id", "props")).drop("samples")


def _order_json(spark, d):
    li = _read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("id"), F.lit("line").alias("$type"), F.col("l_returnflag").alias("flag")))).alias("lines"))
    o = _read(spark, d, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.lit("order").alias("$type"), F.col("o_orderstatus").alias("status"), "lines")).alias("doc"))


@_query("json_walk_owners", "select o_orderkey as id, '$.status' as path, o_orderkey::varchar as owner, o_orderstatus as value from orders where o_orderkey in (select l_orderkey from lineitem) union all select l_orderkey, '$.lines[*].flag', l_linenumber::varchar, l_returnflag from lineitem where l_orderkey in (select o_orderkey from orders)")
def _json_walk(spark, d):
    return jsonwalk.walk(_order_json(spark, d), "o_orderkey", "doc").where("key in ('status', 'flag')").select("id", "path", "owner", "value")


@_query("type_catalogue", "select 'order' as type, count(distinct l_orderkey) as objects, '$type,id,lines,status' as keys from lineitem where l_orderkey in (select o_orderkey from orders) union all select 'line', count(*), '$type,flag,id' from lineitem where l_orderkey in (select o_orderkey from orders)")
def _type_catalogue(spark, d):
    w = jsonwalk.walk(_order_json(spark, d), "o_orderkey", "doc", type_key="$type")
    out = jsonwalk.type_catalogue(w)
    return out.select("type", "objects", F.array_join("keys", ",").alias("keys"))


@_query("json_diff", "select event_id as id, '$.k' as path, 'changed' as change from events where event_id % 7 = 0 and json_extract(props, '$.k') is not null union all select event_id, '$.extra', 'added' from events where event_id % 5 = 0")
def _json_diff(spark, d):
    e = _read(spark, d, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k").cast("long")
    new = e.select("event_id", F.to_json(F.struct(F.when(F.col("event_id") % 7 == 0, k + 1).otherwise(k).alias("k"), F.when(F.col("event_id") % 5 == 0, F.lit("x")).alias("extra"))).alias("props"))
    return jsonwalk.structural_diff(e, new, "event_id", "props").select("id", "path", "change")


# Matching and merging

def _sides(spark, d):
    c = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("s"), "c_custkey")).alias("selector"), F.concat(F.lit("k"), (F.col("c_custkey") % 400).cast("string")).alias("code"), F.col("c_custkey").alias("pos"))
    s = _read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("s"), "s_suppkey")).alias("selector"), F.concat(F.lit("k"), (F.col("s_suppkey") % 70).cast("string")).alias("code"), F.col("s_suppkey").alias("pos"))
    return c, s


_MATCH = """with l as (select c_custkey as id, case when c_custkey % 3 = 0 then 's' || c_custkey end as selector, 'k' || (c_custkey % 400) as code from customer),
r as (select s_suppkey as id, case when s_suppkey % 2 = 0 then 's' || s_suppkey end as selector, 'k' || (s_suppkey % 70) as code from supplier),
m1 as (select a.id as left_id, b.id as right_id, 'selector' as matched_by from (select selector, min(id) as id from l where selector is not null group by 1) a join (select selector, min(id) as id from r where selector is not null group by 1 having count(*) = 1) b using (selector)),
l2 as (select * from l where id not in (select left_id from m1)), r2 as (select * from r where id not in (select right_id from m1)),
m2 as (select a.id as left_id, b.id as right_id, 'code' as matched_by from (select code, min(id) as id from l2 group by 1) a join (select code, min(id) as id from r2 group by 1 having count(*) = 1) b using (code)),
m as (select * from m1 union all select * from m2 union all select id, null, null from l2 where id not in (select left_id from m2) union all select null, id, null from r2 where id not in (select right_id from m2))
"""


@_query("cascade_match", _MATCH + "select * from m")
def _cascade(spark, d):
    c, s = _sides(spark, d)
    return match.cascade_match(c, s, ["selector", "code"], "id", "pos")


@_query("compare_verdicts", _MATCH + "select case when right_id is null then 'missing' when left_id is null then 'extra' else 'matched' end as verdict, count(*) as n from m group by 1")
def _verdicts(spark, d):
    c, s = _sides(spark, d)
    return match.compare(match.cascade_match(c, s, ["selector", "code"], "id", "pos")).groupBy("verdict").agg(F.count("*").alias("n"))


@_query("compatibility", _MATCH + "select 'party' as concept, count(right_id) as matched, count(*) as total, round(100 * count(right_id) / count(*), 1) as percent from m where left_id is not null")
def _compat(spark, d):
    c, s = _sides(spark, d)
    m = match.compare(match.cascade_match(c, s, ["selector", "code"], "id", "pos")).withColumn("concept", F.lit("party"))
    return match.compatibility(m, "exact")


@_query("scope_kind", "select (select count(distinct doc_id) from documents) as n_left, (select count(distinct doc_id) from labels) as n_right, (select count(distinct doc_id) from labels where doc_id in (select doc_id from documents)) as n_shared, case when (select count(distinct doc_id) from documents) = (select count(distinct doc_id) from labels) then 'exact' else 'partial' end as scope")
def _scope(spark, d):
    return match.scope(_read(spark, d, "documents"), _read(spark, d, "labels"), "doc_id")


@_query("coverage_states", "select d.doc_id, case when l.quality > 0 then 'yes' when l.quality = 0 then 'no' else 'unknown' end as coverage from documents d left join labels l using (doc_id)")
def _coverage(spark, d):
    return _read(spark, d, "documents").select("doc_id").join(_read(spark, d, "labels"), "doc_id", "left").select("doc_id", match.coverage(F.col("quality")).alias("coverage"))


@_query("pair_names", "with l as (select r_regionkey as left_id, lower(r_name) as ln from region), r as (select n_nationkey as right_id, lower(n_name) as rn from nation union all select 100 + r_regionkey, lower(r_name)[1:3] from region union all select 200 + r_regionkey, lower(r_name) from region) select left_id, right_id, case when ln = rn then 'exact' when starts_with(ln, rn) or starts_with(rn, ln) then 'prefix' else 'contains' end as how from l, r where contains(ln, rn) or contains(rn, ln)")
def _pairs(spark, d):
    r, n = _read(spark, d, "region"), _read(spark, d, "nation")
    left = r.select(F.col("r_regionkey").alias("id"), t.fold_match(F.col("r_name")).alias("name"))
    right = n.select(F.col("n_nationkey").alias("id"), t.fold_match(F.col("n_name")).alias("name"))
    right = right.unionByName(left.select((F.col("id") + 100).alias("id"), F.substring("name", 1, 3).alias("name"))).unionByName(left.select((F.col("id") + 200).alias("id"), "name"))
    return match.pair_by_name(left, right, "name", "id")


@_query("set_variance", "select l_returnflag as item, count(distinct l_linestatus) as groups, count(distinct l_linestatus) = (select count(distinct l_linestatus) from lineitem) as always from lineitem group by 1")
def _variance(spark, d):
    return match.set_variance(_read(spark, d, "lineitem"), "l_linestatus", "l_returnflag")


@_query("scope_conflicts", "with e as (select distinct o_orderkey as id, o_custkey || ':' || o_orderstatus as entry from orders), h as (select entry, min(id) as head from e group by 1), c as (select e.id, h.head as other, e.entry from e join h using (entry) where e.id <> h.head) select id, other, entry from c")
def _conflicts(spark, d):
    o = _read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.array(F.concat_ws(":", "o_custkey", "o_orderstatus")).alias("entries"), F.col("o_orderkey").alias("pos"))
    return match.first_clash(o, "id", "entries", "pos")


@_query("full_merge", "select coalesce(d.doc_id, l.doc_id) as doc_id, d.lang as lang_a, null::varchar as lang_b, case when d.doc_id is not null and l.doc_id is not null then 'both' when l.doc_id is null then 'a' else 'b' end as source from documents d full join (select doc_id * 2 as doc_id from labels) l on d.doc_id = l.doc_id")
def _full_merge(spark, d):
    a = _read(spark, d, "documents").select("doc_id", "lang")
    b = _read(spark, d, "labels").select((F.col("doc_id") * 2).alias("doc_id"), F.lit(None).cast("string").alias("lang"))
    return merge.full_merge(a, b, "doc_id", apart=["lang"])


@_query("last_known", "select user_id, arg_max(event_type, event_id) filter (event_type <> 'view') as event_type, arg_max(value, event_id) as value from (select user_id, event_id, event_type, value from events) group by 1")
def _last_known(spark, d):
    e = _read(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"), "value")
    return merge.last_known(e, "user_id", "event_id", ["event_type", "value"])


@_query("assign_systems", "select l_orderkey, l_linenumber, coalesce(s.s_nationkey, c.c_nationkey) as system from lineitem left join (select s_suppkey * 2 as k, s_nationkey from supplier) s on l_suppkey = k left join orders on l_orderkey = o_orderkey left join customer c on o_custkey = c_custkey")
def _assign(spark, d):
    li = _read(spark, d, "lineitem").join(_read(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    rows = li.select("l_orderkey", "l_linenumber", F.concat(F.lit("s"), "l_suppkey").alias("a"), F.concat(F.lit("c"), "o_custkey").alias("b"))
    own = _read(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey") * 2).alias("id"), F.col("s_nationkey").alias("system"))
    own = own.unionByName(_read(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_nationkey").alias("system")))
    return merge.assign(rows, ["a", "b"], own, "id", "system").select("l_orderkey", "l_linenumber", "system")


@_query("presence_matrix", "select n_name, n_nationkey in (select c_nationkey from customer where c_acctbal < -950) as in_debt, n_nationkey in (select s_nationkey from supplier) as in_supplier from nation")
def _presence(spark, d):
    n = _read(spark, d, "nation")
    debt = _read(spark, d, "customer").where("c_acctbal < -950").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.upper("n_name").alias("n"))
    sup = _read(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name")
    return merge.presence(n.select("n_name"), "n_name", {"debt": (debt, "n"), "supplier": (sup, "n_name")})


@_query("absent_values", "select distinct c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 200000) order by 1 limit 200")
def _absent(spark, d):
    return merge.absent(_read(spark, d, "customer"), "c_custkey", _read(spark, d, "orders").where("o_totalprice > 200000"), "o_custkey", 200)


@_query(
    "staleness",
    "with o as (select doc_id, sha256(coalesce(text, '')) as h from documents), n as (select doc_id + 11 as doc_id, h from o), "
    "j as (select coalesce(o.doc_id, n.doc_id) as doc_id, case when n.doc_id is null then 'gone' when o.doc_id is null then 'new' when n.h <> o.h then 'changed' end as state from o full join n on o.doc_id = n.doc_id) select * from j where state is not null",
)
def _stale(spark, d):
    h = _read(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    now = h.select((F.col("doc_id") + 11).alias("doc_id"), "h")
    return merge.staleness(h, now, "doc_id", "h")


@_query("append_if_new", "select n_name, n_regionkey from nation union all select r_name, r_regionkey from region where r_name not in (select n_name from nation)")
def _append(spark, d):
    n, r = _read(spark, d, "nation").select("n_name", "n_regionkey"), _read(spark, d, "region").select(F.col("r_name").alias("n_name"), F.col("r_regionkey").alias("n_regionkey"))
    return merge.append_if_new(n, r.unionByName(n), ["n_name", "n_regionkey"])


@_query("patch_rows", "select c_custkey, case when c_custkey % 3 = 0 then null else c_mktsegment end as c_mktsegment, case when c_custkey % 2 = 0 then 'n' || c_custkey else c_name end as c_name from customer")
def _patch(spark, d):
    c = _read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    name, seg = F.concat(F.lit('"c_name":"n'), "c_custkey", F.lit('"')), F.lit('"c_mktsegment":null')
    k = F.col("c_custkey")
    body = F.concat_ws(",", F.when(k % 2 == 0, name), F.when(k % 3 == 0, seg))
    return merge.patched(c, c.select("c_custkey", F.concat(F.lit("{"), body, F.lit("}")).alias("patch")), "c_custkey", ["c_mktsegment", "c_name"])


@_query("upsert_plan", "select k as c_nationkey, case when n is null then 'create' when n = 1 then 'update' else 'ambiguous' end as action from (select unnest(range(0, 40))::int as k) left join (select s_nationkey, count(*) as n from supplier group by 1) on k = s_nationkey")
def _upsert(spark, d):
    wanted = spark.range(40).select(F.col("id").cast("int").alias("c_nationkey"))
    return merge.upsert_plan(wanted, _read(spark, d, "supplier").select(F.col("s_nationkey").alias("c_nationkey")), "c_nationkey")


# Evidence

_KINDS = "case event_type when 'view' then 'IL' when 'click' then 'ExportSample' when 'purchase' then 'ConfigLiteral' else 'Inference' end"


def _evidence(spark, d):
    kind = F.when(F.col("event_type") == "view", "IL").when(F.col("event_type") == "click", "ExportSample").when(F.col("event_type") == "purchase", "ConfigLiteral").otherwise("Inference")
    return _read(spark, d, "events").select("user_id", kind.alias("kind"), "event_id", "event_type")


@_query("confidence_levels", f"with e as (select user_id, {_KINDS} as k from events), g as (select user_id, count(distinct case when k <> 'Inference' then k end) as families, bool_or(k = 'Inference') as guessed from e group by 1) select user_id, case when families >= 2 then 'CrossVerified' when families = 1 then 'Verified' when guessed then 'Inferred' else 'Unknown' end as confidence, families from g")
def _confidence(spark, d):
    return evidence.confidence(_evidence(spark, d), ["user_id"], "kind")


@_query("weakest_link", "select user_id, case max(case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 4 else 5 end) when 1 then 'CrossVerified' when 2 then 'Verified' when 4 then 'Inferred' else 'Unknown' end as confidence from events group by 1")
def _weakest(spark, d):
    level = F.when(F.col("event_type") == "view", "CrossVerified").when(F.col("event_type") == "click", "Verified").when(F.col("event_type") == "purchase", "Inferred").otherwise("other")
    return evidence.weakest(_read(spark, d, "events").withColumn("level", level), ["user_id"], "level")


@_query("evidence_ledger", "with e as (select 'EVT' as prefix, event_type as source, (user_id % 10)::varchar as detail, '' as locator, min(event_id) as first from events group by all) select 'EVID-EVT-' || lpad(row_number() over (order by first, source, detail, locator)::varchar, 6, '0') as evidence_id, prefix, source, detail, locator from e")
def _ledger(spark, d):
    e = _read(spark, d, "events").select(F.lit("EVT").alias("prefix"), F.col("event_type").alias("source"), (F.col("user_id") % 10).cast("string").alias("detail"), F.lit("").alias("locator"), "event_id")
    return evidence.ledger(e, "event_id")


@_query("gap_register", "select event_type as topic, min_by(props, event_id) as reason, string_agg(distinct (user_id % 5)::varchar, ',' order by (user_id % 5)::varchar) as needed_for from events group by 1")
def _gaps(spark, d):
    g = _read(spark, d, "events").select(F.col("event_type").alias("topic"), F.col("props").alias("reason"), (F.col("user_id") % 5).cast("string").alias("needed_for"), F.col("event_id").alias("pos"))
    return evidence.gaps(g).withColumn("needed_for", F.array_join("needed_for", ","))


# Change batches, from orders: a customer is a batch, an order a command

def _commands(spark, d):
    k = F.col("o_orderkey")
    ref = lambda sel, temp: F.struct(sel.alias("selector"), temp.alias("tempId"))
    none = F.lit(None).cast("string")
    return _read(spark, d, "orders").select(
        F.col("o_custkey").alias("batch_id"), k.alias("pos"), F.when(k % 50 == 0, F.lit("c")).otherwise(F.concat(F.lit("c"), k)).alias("commandId"),
        F.when(F.col("o_orderstatus") == "F", "create").when(F.col("o_orderstatus") == "O", "update").otherwise("archive").alias("operation"),
        F.when(k % 2 == 0, "report").otherwise("folder").alias("objectType"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("t"), k % 7)).alias("tempId"),
        F.when(F.col("o_orderstatus") == "O", ref(F.concat(F.lit("#o"), k % 13), none)).alias("target"), F.when(F.col("o_orderstatus") == "F", ref(F.concat(F.lit("#p"), k % 17), F.concat(F.lit("t"), (k + 1) % 7))).alias("parent"),
        F.when(k % 9 == 0, '{"id": 1}').otherwise('{"name": "x"}').alias("properties"),
    )


_CMD = "with c as (select o_custkey as batch_id, o_orderkey as pos, case when o_orderkey % 50 = 0 then 'c' else 'c' || o_orderkey end as cid, case o_orderstatus when 'F' then 'create' when 'O' then 'update' else 'archive' end as op, case when o_orderkey % 2 = 0 then 'report' else 'folder' end as ot, case when o_orderstatus = 'F' then 't' || (o_orderkey % 7) end as tid, case when o_orderstatus = 'O' then '#o' || (o_orderkey % 13) when o_orderstatus = 'F' then '#p' || (o_orderkey % 17) end as sel, case when o_orderstatus = 'F' then 't' || ((o_orderkey + 1) % 7) end as ptid, case when o_orderkey % 9 = 0 then 'id' else 'name' end as prop from orders) "


@_query("lint_rules", _CMD + "select batch_id, 'lint' as gate, pos, 'commandId is used twice: ' || cid as message, 'error' as severity from c where pos > (select min(pos) from c c2 where c2.batch_id = c.batch_id and c2.cid = c.cid) union all select batch_id, 'lint', pos, 'unknown operation', 'error' from c where op = 'archive' union all select batch_id, 'lint', pos, 'tempId is used twice: ' || tid, 'error' from c where tid is not null and pos > (select min(pos) from c c2 where c2.batch_id = c.batch_id and c2.tid = c.tid) union all select batch_id, 'lint', pos, 'tempId is never created: ' || ptid, 'error' from c where ptid is not null and not exists (select 1 from c c2 where c2.batch_id = c.batch_id and c2.tid = c.ptid) union all select batch_id, 'lint', pos, 'runtime key: id', 'error' from c where prop = 'id'")
def _lint(spark, d):
    return batch.lint(_commands(spark, d), ["report", "folder"])


@_query("gate_selectors", _CMD + "select batch_id, 'selectors' as gate, pos, 'unknown selector: ' || sel as message, 'error' as severity from c where sel is not null and sel not in (select '#o' || i from range(0, 10) t(i) union all select '#p' || i from range(0, 15) t(i))")
def _gate_selectors(spark, d):
    index = spark.range(10).select(F.concat(F.lit("#o"), "id").alias("selector")).unionByName(spark.range(15).select(F.concat(F.lit("#p"), "id").alias("selector")))
    return batch.selector_gate(_commands(spark, d), index)


@_query("gate_unknowns", _CMD + "select batch_id, 'unknowns' as gate, pos, 'not authorable: ' || prop as message, 'error' as severity from c where not (prop = 'name' and (op = 'create' or (op = 'update' and ot = 'report')))")
def _gate_unknowns(spark, d):
    contract = spark.createDataFrame([("report", "name", True, True), ("folder", "name", True, False)], "objectType string, property string, create boolean, update boolean")
    return batch.unknown_gate(_commands(spark, d), contract)


@_query("gate_scope", _CMD + "select batch_id, 'scope' as gate, pos, 'not allowed: ' || ot || ':' || coalesce(case when op = 'update' then sel end, case when prop = 'name' then 'x' end, tid, '?') as message, 'error' as severity from c where ot <> 'report' union all select batch_id, 'scope', pos, 'denied: ' || ot || ':' || sel, 'error' from c where op = 'update' and ot = 'report' and sel = '#o3'")
def _gate_scope(spark, d):
    c = _commands(spark, d)
    b = c.select("batch_id").distinct()
    return batch.scope_gate(c, b.withColumn("entry", F.lit("report:*")), b.withColumn("entry", F.lit("report:#o3")))


@_query("gate_order", _CMD + ", r as (select *, case ot when 'folder' then 1 else 2 end as rank, lag(case ot when 'folder' then 1 else 2 end) over (partition by batch_id order by pos) as before from c) select batch_id, 'order' as gate, pos, 'stands after its dependants' as message, 'error' as severity from r where rank < before union all select c.batch_id, 'order', c.pos, 'parent is created later: ' || c.ptid, 'error' from c join (select batch_id, tid, min(pos) as made from c where op = 'create' group by all) m on m.batch_id = c.batch_id and m.tid = c.ptid where made >= c.pos")
def _gate_order(spark, d):
    ranks = spark.createDataFrame([("folder", 1), ("report", 2)], "objectType string, rank int")
    return batch.order_gate(_commands(spark, d), ranks)


@_query("gate_summary", _CMD + "select b.batch_id, g.gate, coalesce(case when g.gate = 'unknowns' then n end, 0)::bigint as errors, 0::bigint as warnings, coalesce(case when g.gate = 'unknowns' then n end, 0) = 0 as passed from (select distinct batch_id from c) b, (values ('lint'), ('selectors'), ('unknowns'), ('scope'), ('order')) g(gate) left join (select batch_id, count(*) as n from c where not (prop = 'name' and op = 'create') group by 1) f on f.batch_id = b.batch_id")
def _gate_summary(spark, d):
    c = _commands(spark, d)
    contract = spark.createDataFrame([("report", "name", True, False), ("folder", "name", True, False)], "objectType string, property string, create boolean, update boolean")
    return batch.summary(c.select("batch_id").distinct(), batch.unknown_gate(c, contract))


_EDGES = "select l_suppkey % 20 as batch_id, l_linenumber + 10 * (l_partkey % 3) as node, l_linenumber + 10 * (l_partkey % 3) - 1 - (l_partkey % 2) * 9 as needs from lineitem"


@_query("plan_levels", f"with recursive e as (select distinct * from ({_EDGES})), n as (select distinct batch_id, node from e), u as (select e.* from e join n on n.batch_id = e.batch_id and n.node = e.needs), t as (select batch_id, node, 0 as level from n union select u.batch_id, u.node, t.level + 1 from t join u on u.batch_id = t.batch_id and u.needs = t.node) select batch_id, node, max(level) as level from t group by 1, 2")
def _plan_levels(spark, d):
    li = _read(spark, d, "lineitem")
    node = F.col("l_linenumber") + 10 * (F.col("l_partkey") % 3)
    e = li.select((F.col("l_suppkey") % 20).alias("batch_id"), node.alias("node"), (node - 1 - (F.col("l_partkey") % 2) * 9).alias("needs")).distinct()
    return batch.plan_levels(e.select("batch_id", "node").distinct(), e)[0]


@_query("skip_dependants", f"with recursive e as (select distinct * from ({_EDGES})), t as (select distinct batch_id, node from e where node = 3 union select e.batch_id, e.node from e join t on t.batch_id = e.batch_id and t.node = e.needs) select * from t where node <> 3")
def _skip(spark, d):
    li = _read(spark, d, "lineitem")
    node = F.col("l_linenumber") + 10 * (F.col("l_partkey") % 3)
    e = li.select((F.col("l_suppkey") % 20).alias("batch_id"), node.alias("node"), (node - 1 - (F.col("l_partkey") % 2) * 9).alias("needs")).distinct()
    return batch.skipped(e, e.where("node = 3").select("batch_id", "node").distinct())


# Events and state

@_query("state_transitions", "with e as (select event_id, user_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as previous from events) select event_id, previous, previous is null or (previous = 'view' and event_type in ('click', 'view')) or (previous = 'click' and event_type in ('purchase', 'view')) as legal from e")
def _transitions(spark, d):
    edges = spark.createDataFrame([("view", "click"), ("view", "view"), ("click", "purchase"), ("click", "view")], "src string, dst string")
    return workflow.transitions(_read(spark, d, "events"), "user_id", "event_type", ["ts", "event_id"], edges).select("event_id", "previous", "legal")


@_query("budget_running", "select event_id, count(*) over (partition by user_id, event_type order by ts, event_id rows unbounded preceding) as used, count(*) over (partition by user_id, event_type order by ts, event_id rows unbounded preceding) > 5 as exceeded from events")
def _budget(spark, d):
    return workflow.budget(_read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], 5).select("event_id", "used", "exceeded")


@_query("latest_attempt", "select conv_id, arg_max(turn, turn) as turn, arg_max(role, turn) as role from conversations group by 1")
def _latest(spark, d):
    return workflow.latest(_read(spark, d, "conversations"), "conv_id", F.col("turn"), ["turn", "role"])


@_query("event_sessions", "with e as (select user_id, ts, case when lag(ts) over w is null or ts > lag(ts) over w + interval 10 minute then 1 else 0 end as new from events window w as (partition by user_id order by ts)), s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as n from e) select user_id, min(ts) as start, max(ts) + interval 10 minute as end, count(*) as events from s group by user_id, n")
def _sessions(spark, d):
    return workflow.sessions(_read(spark, d, "events"), "user_id", "ts")


# Search, audits, sources

@_query("retrieve_exact", "select p_partkey, p_name, true as exact from part where p_partkey = 17")
def _retrieve_exact(spark, d):
    return retrieve.retrieve(_read(spark, d, "part").select("p_partkey", "p_name"), ["p_partkey", "p_name"], "17")


@_query("retrieve_contains", "select p_partkey, p_brand, false as exact from part where contains(lower(p_brand), 'and#2')")
def _retrieve_contains(spark, d):
    return retrieve.retrieve(_read(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], "AND#2")


@_query("retrieve_page", "select p_partkey, p_brand from part where contains(lower(p_brand), 'and#2') order by 1 limit 25 offset 50")
def _retrieve_page(spark, d):
    rows = retrieve.retrieve(_read(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], "AND#2").drop("exact")
    return retrieve.page(rows, ["p_partkey"], 50)


@_query("find_ambiguous", "select n_nationkey as id, n_name as caption, 3 as tier, case when count(*) over () = 1 then 'found' else 'ambiguous' end as status from nation where contains(lower(n_name), 'ation_1')")
def _find(spark, d):
    return retrieve.find(_read(spark, d, "nation"), "n_nationkey", "n_name", "ation_1")


@_query("bounded_projection", "select count(*) as rows, sum(strlen(props))::bigint as bytes, sum(strlen(props)) > 120000 as summarised from events")
def _bounded(spark, d):
    return retrieve.bounded(_read(spark, d, "events"), "props")


@_query("audit_gates", "select 'orphan orders' as gate, count(*) as offenders, count(*) = 0 as passed from orders where o_custkey not in (select c_custkey from customer) union all select 'unlabelled', count(*), count(*) = 0 from documents where doc_id not in (select doc_id from labels)")
def _audit(spark, d):
    o = _read(spark, d, "orders").join(_read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    u = _read(spark, d, "documents").join(_read(spark, d, "labels"), "doc_id", "left_anti")
    return audit.all_passed([audit.gate("orphan orders", o), audit.gate("unlabelled", u)])


@_query("audit_budget", "select coalesce(sum(case when source <> 'src0' then n_chars end), 0)::bigint as total_bytes, coalesce(sum(case when source <> 'src0' and lang = 'en' then n_chars end), 0)::bigint as contract_bytes, max(n_chars) as largest, count(*) as files, coalesce(sum(case when source <> 'src0' then n_chars end), 0) <= 512000 and coalesce(sum(case when source <> 'src0' and lang = 'en' then n_chars end), 0) <= 122880 and max(n_chars) <= 153600 as passed from documents")
def _audit_budget(spark, d):
    return audit.budget(_read(spark, d, "documents"), "n_chars", F.col("source") == "src0", F.col("lang") == "en")


@_query("group_membership", "select l_suppkey as item, 'duplicated' as problem from lineitem group by 1 having count(distinct l_returnflag) > 1 union all select distinct l_suppkey, 'drift' from lineitem where l_suppkey not in (select s_suppkey + 5 from supplier) union all select s_suppkey + 5, 'uncovered' from supplier where s_suppkey + 5 not in (select l_suppkey from lineitem)")
def _membership(spark, d):
    m = _read(spark, d, "lineitem").select(F.col("l_suppkey").alias("item"), "l_returnflag")
    return audit.group_membership(m, _read(spark, d, "supplier").select((F.col("s_suppkey") + 5).alias("item")), "l_returnflag", "item")


@_query("unique_constraint", "select o_custkey, o_orderstatus, count(*) as n from orders group by 1, 2 having count(*) > 1")
def _unique(spark, d):
    return audit.duplicates(_read(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@_query("content_hash", "select sha256(coalesce(text, '')) as sha256, min(doc_id) as first_id, count(*) as n from documents group by 1")
def _content_hash(spark, d):
    return catalogues.copies(_read(spark, d, "documents"), "text", "doc_id")


@_query("sniff_content", "select page_id, case when starts_with(ltrim(html), '<') then 'XML' else 'Binary' end as physical from pages")
def _sniff(spark, d):
    return _read(spark, d, "pages").select("page_id", formats.sniff(F.encode("html", "utf-8")).alias("physical"))


@_query("document_lines", "select doc_id as path, count(*) as lines from (select doc_id, unnest(string_split(text, chr(10))) as l from documents) group by 1")
def _doc_lines(spark, d):
    return docsrc.number_lines(_read(spark, d, "documents"), "doc_id", "text").groupBy("path").agg(F.count("*").alias("lines"))


@_query("stable_json", "select '{\"a\":' || r_regionkey || ',\"z\":\"' || r_name || '\"}' as json from region")
def _stable(spark, d):
    return sinks.stable_json(_read(spark, d, "region").select(F.col("r_name").alias("z"), F.col("r_regionkey").alias("a")))


@_query("trimmed_samples", "select * from (select n_regionkey, n_name, count(*) over (partition by n_regionkey) as total, row_number() over (partition by n_regionkey order by n_name) as rn from nation) where rn <= 3".replace("select * from", "select n_regionkey, n_name, total from"))
def _trimmed(spark, d):
    return sinks.trimmed(_read(spark, d, "nation").select("n_regionkey", "n_name"), "n_regionkey", ["n_name"], 3)


# More of the inventory

_report(
    "cond_text_search_any",
    {"entity": "part", "columns": _PART, "condition": {"field": "p_name", "operator": "advancedTextSearch2", "value": "Ring widget"}},
    "select p_partkey, p_name from part where list_has_any(string_split_regex(lower(p_name), '\\s+'), ['ring', 'widget'])",
    allow_text_search=True,
)
_report(
    "role_mapping",
    {"entity": "orders", "columns": [{"field": "o_orderdate", "alias": "start"}, {"field": {"items": ["#customer", "#c_name"]}, "alias": "owner"}, {"field": "o_orderkey", "alias": "title"}], "calendar": {"start": "start", "owner": "owner"}},
    "select o_orderdate as start, c_name as owner, o_orderkey as title from orders left join customer on o_custkey = c_custkey",
)
_report(
    "ignored_columns",
    {"entity": "orders", "columns": [*_ORDER, {"field": "o_totalprice", "alias": "p"}], "ignoreColumns": ["p"], "additionalWhere": "o_orderstatus = 'P'"},
    "select o_orderkey, o_orderpriority as priority from orders where o_orderstatus = 'P'",
)
_report(
    "grid_grouping_keeps_rows",
    {"entity": "orders", "columns": _ORDER, "gridGrouping": ["priority"], "condition": {"field": "o_orderstatus", "operator": "equal", "value": "P"}},
    "select o_orderkey, o_orderpriority as priority from orders where o_orderstatus = 'P'",
)
_report(
    "relation_key_as_value",
    {"entity": "orders", "columns": [{"field": "o_orderkey", "alias": "k"}, {"field": "#customer", "alias": "customer"}, {"field": {"items": ["customer", {"self": True}]}, "alias": "customer_id"}]},
    "select o_orderkey as k, o_custkey as customer, c_custkey as customer_id from orders left join customer on o_custkey = c_custkey",
)


@_query("heterogeneous_tree", "select 'region' as kind, 0 as level, r_name as name from region union all select 'nation', 1, n_name from nation union all select 'customer', 2, c_name from customer")
def _hetero(spark, d):
    read = lambda name, c, key, up: _read(spark, d, name).select(F.col(c).alias("name"), F.col(key).alias("key"), (F.col(up) if up else F.lit(None)).cast("long").alias("up"))
    parts = [("region", read("region", "r_name", "r_regionkey", None), None), ("nation", read("nation", "n_name", "n_nationkey", "n_regionkey"), "region"), ("customer", read("customer", "c_name", "c_custkey", "c_nationkey"), "nation")]
    placed, _ = forest.labels(forest.forest([(k, df, "key", up, "up" if up else None) for k, df, up in parts]))
    names = reduce(DataFrame.unionByName, (df.select(F.concat(F.lit(f"{k}:"), F.col("key").cast("string")).alias("id"), F.lit(k).alias("kind"), "name") for k, df, _ in parts))
    return placed.join(names, "id").select("kind", F.col("depth").cast("int").alias("level"), "name")


@_query("path_descendants", "select r_name || '/' || n_name as path from nation join region on n_regionkey = r_regionkey where starts_with(r_name || '/' || n_name, 'ASIA/')")
def _descendants(spark, d):
    p = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat_ws("/", "r_name", "n_name").alias("path"))
    placed, _ = forest.labels(hierarchy.path_prefixes(p, "path"), "path", "parent_path")
    return forest.descendants(placed, p.select(F.lit("ASIA").alias("id")).distinct()).select(F.col("id").alias("path"))


@_query("inverted_index", "select l_suppkey as callee, string_agg(distinct l_returnflag, ',' order by l_returnflag) as callers from lineitem group by 1")
def _inverted(spark, d):
    return catalogues.inverted(_read(spark, d, "lineitem"), "l_returnflag", "l_suppkey").select("callee", F.array_join("callers", ",").alias("callers"))


@_query("argmax", "select o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) as largest from orders group by 1")
def _argmax(spark, d):
    return catalogues.argmax(_read(spark, d, "orders"), ["o_custkey"], "o_orderkey", ["o_totalprice", "o_orderkey"], "largest")


@_query("bounded_sites", "select p_type as literal, array_to_string(list_sort(list(p_partkey))[1:8], ',') as sites, count(*) as n from part where length(p_type) between 1 and 8000 group by 1")
def _sites(spark, d):
    return catalogues.sites(_read(spark, d, "part"), "p_type", "p_partkey").withColumn("sites", F.array_join("sites", ","))


@_query("owned_index", "select p_partkey, p_brand from part where regexp_matches(p_brand, '^(Brand#1|Brand#2)') and not regexp_matches(p_name, '^(get_|set_)')")
def _owned(spark, d):
    return catalogues.owned(_read(spark, d, "part"), "p_brand", "^(Brand#1|Brand#2)", "p_name", "^(get_|set_)").select("p_partkey", "p_brand")


@_query("domain_tags", "select t as term, count(distinct p_partkey) as types from (values ('red'), ('blue'), ('widget')) v(t), part where contains(lower(p_name), t) group by 1")
def _domains(spark, d):
    return catalogues.tagged(_read(spark, d, "part"), "p_partkey", "p_name", ["red", "blue", "widget"]).withColumnRenamed("n", "types")


@_query("obfuscation_ratio", "select p_brand, round(count(*) filter (p_size > 25) / count(*), 3) as ratio from part group by 1")
def _obfuscation(spark, d):
    return _read(spark, d, "part").groupBy("p_brand").agg(t.ratio(F.count_if(F.col("p_size") > 25), F.count("*")).alias("ratio"))


@_query("vocabulary_pairs", "select event_type as ai_value, (user_id % 4)::varchar as legacy_value, count(*) as n from events group by 1, 2")
def _vocabulary(spark, d):
    e = _read(spark, d, "events")
    out = catalogues.vocabulary(e.select("event_id", "event_type"), e.select("event_id", (F.col("user_id") % 4).cast("string").alias("kind")), "event_id", "event_type", "kind")
    return out.select(F.col("left").alias("ai_value"), F.col("right").alias("legacy_value"), "n")


@_query("system_counts", "select n_nationkey as system, coalesce(c.n, 0) as artifact, coalesce(s.n, 0) as legacy, case when n_regionkey < 3 then coalesce(c.n, 0) = coalesce(s.n, 0) end as agrees from nation left join (select c_nationkey k, count(*) n from customer group by 1) c on c.k = n_nationkey left join (select s_nationkey k, count(*) n from supplier group by 1) s on s.k = n_nationkey")
def _systems(spark, d):
    sides = {"artifact": (_read(spark, d, "customer"), "c_nationkey"), "legacy": (_read(spark, d, "supplier"), "s_nationkey")}
    return catalogues.reconciled(_read(spark, d, "nation"), "n_nationkey", sides, F.col("n_regionkey") < 3)


@_query(
    "acceptance_ids",
    "select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, '') || ' AC-' || n_chars || ', AC-9', 'AC-[0-9]+'))), ',') as ids from documents",
)
def _acceptance(spark, d):
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" AC-"), "n_chars", F.lit(", AC-9"))
    return _read(spark, d, "documents").select("doc_id", F.array_join(t.acceptance_ids(text), ",").alias("ids"))


@_query("identity_states", "select o_orderkey, case when o_orderstatus = 'P' then 'unreported' when o_orderstatus = 'F' then 'match' else 'mismatch' end as state from orders")
def _identity(spark, d):
    o = _read(spark, d, "orders")
    return o.select("o_orderkey", audit.same_identity(F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus")), F.lit("F")).alias("state"))


@_query("difference_kinds", "select event_id, case when event_id % 4 = 0 then 'notComparable' when event_id % 4 = 1 then 'outsideScopePossible' when event_id % 3 = 0 then 'versionDrift' else 'difference' end as kind from events")
def _kinds(spark, d):
    k = F.col("event_id")
    scope = F.when(k % 4 == 0, "disjoint").when(k % 4 == 1, "partial").otherwise("exact")
    return _read(spark, d, "events").select("event_id", match.difference_kind(F.lit("missing"), scope, k % 3 != 0).alias("kind"))


@_query("snapshot_diff", "select s_suppkey as id, 'changed' as change, '$.balance' as path from supplier where s_suppkey % 10 = 0")
def _snapshot(spark, d):
    s = _read(spark, d, "supplier")
    doc = lambda balance: s.select("s_suppkey", F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), balance.alias("balance"))).alias("doc"))
    old, new = doc(F.lit(1)), doc(F.when(F.col("s_suppkey") % 10 == 0, 2).otherwise(1))
    return jsonwalk.structural_diff(old, new, "s_suppkey", "doc").select("id", "change", "path")


@_query("consumed_once", "select user_id, event_type, min(event_id) as first_id from events group by 1, 2")
def _consumed(spark, d):
    return windows.consumed(_read(spark, d, "events"), ["user_id", "event_type"], ["event_id"], ["event_id"]).withColumnRenamed("event_id", "first_id")


@_query("header_findings", "select c_custkey as batch_id, 'lint' as gate, null::bigint as pos, 'profileVersion must be 15' as message, 'error' as severity from customer where c_custkey % 4 = 0 union all select c_custkey, 'lint', null, 'no changes', 'error' from customer where c_custkey % 5 = 0")
def _headers(spark, d):
    k = F.col("c_custkey")
    h = _read(spark, d, "customer").select(k.alias("batch_id"), F.when(k % 4 == 0, 14).otherwise(15).alias("profileVersion"), F.lit("Stop").alias("errorPolicy"), F.when(k % 5 == 0, 0).otherwise(3).alias("n_changes"))
    return batch.header_findings(h)


@_query("promotion_audit", "select event_type from (select event_type, max(case when user_id % 2 = 0 then 4 else 1 end) as s from events group by 1) where s = 4")
def _promotion(spark, d):
    e = _read(spark, d, "events")
    src = evidence.weakest(e.withColumn("level", F.when(F.col("user_id") % 2 == 0, "Inferred").otherwise("CrossVerified")), ["event_type"], "level")
    pub = e.select("event_type").distinct().withColumn("confidence", F.lit("CrossVerified"))
    return evidence.promotions(pub, src, "event_type").select("event_type")


def entry(spark: SparkSession, d: str) -> DataFrame:
    return QUERIES["path_join_4hop"](spark, d)


from . import queries_changes, queries_model, queries_relations, queries_sources, queries_streams  # noqa: E402,F401  register their queries
