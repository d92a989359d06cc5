"""Operators of the model, of change plans and of the task log as queries over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions.text import fold_match
from .catalog import testdata
from .operators import catalogues, jsonwalk, model
from .queries import _order_json, _query, _read
from .streaming import workflow

_STATUS = "case o_orderstatus when 'F' then 'integrated' when 'O' then 'implementing' else 'review' end"


@_query("unknown_columns", "select p_partkey, cast(null as varchar) as data_type from part")
def _unknown(spark, d):
    return model.unknown_columns(_read(spark, d, "part").select("p_partkey"), {"data_type": "string"})


@_query("letter_boundary", "select p_partkey, replace(replace(p_name || 'يك', 'ي', 'ی'), 'ك', 'ک') as shown, p_name || 'يك' as kept from part")
def _letters(spark, d):
    stored = F.concat("p_name", F.lit("يك"))
    return _read(spark, d, "part").select("p_partkey", model.to_application(stored).alias("shown"), model.to_storage(model.to_application(stored)).alias("kept"))


@_query("scoped_keys", "select o_orderkey, case when o_orderstatus <> 'P' then o_custkey || '/' || regexp_replace(lower(o_orderpriority), '\\s+', ' ', 'g') end as k from orders")
def _scoped(spark, d):
    owner = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
    return _read(spark, d, "orders").select("o_orderkey", model.scoped_key(owner, F.col("o_orderpriority")).alias("k"))


_ROUTES = [("click", "gestures"), ("view", "pages"), ("purchase", "sales")]
_ROUTE_SQL = "(values ('click', 'gestures'), ('view', 'pages'), ('purchase', 'sales')) r(event_type, collection)"


def _routes(spark):
    return spark.createDataFrame(_ROUTES, "kind string, collection string")


@_query("type_routing", f"select event_id, e.event_type, collection from events e left join {_ROUTE_SQL} on e.event_type = r.event_type")
def _route(spark, d):
    return model.route(_read(spark, d, "events"), "event_type", _routes(spark)).select("event_id", "event_type", "collection")


@_query(
    "unrouted_types",
    f"select event_type, count(*) as rows, array_to_string(list_sort(list(event_id))[1:5], ',') as samples from events where event_type not in (select event_type from {_ROUTE_SQL}) group by 1",
)
def _unrouted(spark, d):
    out = model.unrouted(_read(spark, d, "events"), "event_type", "event_id", _routes(spark))
    return out.withColumn("samples", F.array_join("samples", ","))


@_query(
    "nested_paths",
    "with recursive t as (select p_partkey as id, case when p_partkey < 8 then null else p_partkey // 8 end as up, p_brand as name from part), "
    "w as (select id, name as path, cast(null as varchar) as parent_path from t where up is null or up not in (select id from t) union all "
    "select t.id, w.path || '/' || t.name, w.path from t join w on t.up = w.id) select * from w",
)
def _nested(spark, d):
    part = _read(spark, d, "part").withColumn("up", F.when(F.col("p_partkey") >= 8, F.floor(F.col("p_partkey") / 8)))
    return model.nested_paths(part, "p_partkey", "up", "p_brand")


@_query("inline_code", "select p_partkey, length(p_name) as code_length from part where p_size % 2 = 0")
def _code(spark, d):
    formula = F.when(F.col("p_size") % 2 == 0, F.struct(F.col("p_name").alias("code")))
    doc = F.to_json(F.struct(F.col("p_partkey").alias("id"), formula.alias("formula")))
    return model.inline_code(_read(spark, d, "part").select("p_partkey", doc.alias("doc")), "p_partkey", "doc")


_USES = "select '#' || p_brand as selector, case when p_size < 3 then 'selector' when p_size < 30 then 'field' else 'entity' end as key from part"


@_query(
    "selector_catalogue",
    f"select selector, string_agg(distinct key, ',' order by key) as keys, bool_or(key = 'selector') as declared, bool_or(key <> 'selector') as referenced from ({_USES}) group by 1",
)
def _selectors(spark, d):
    key = F.when(F.col("p_size") < 3, "selector").when(F.col("p_size") < 30, "field").otherwise("entity")
    uses = _read(spark, d, "part").select(F.concat(F.lit("#"), "p_brand").alias("selector"), key.alias("key"))
    return model.selector_catalogue(uses, ["selector"]).withColumn("keys", F.array_join("keys", ","))


@_query(
    "selector_index",
    "select 'customer' as object_type, c_name as selector, c_custkey::varchar as id from customer where c_acctbal >= 0 union all "
    "select 'nation', n_name, n_nationkey::varchar from nation union all select 'supplier', s_name, s_suppkey::varchar from supplier",
)
def _index(spark, d):
    customer = _read(spark, d, "customer").withColumn("selector", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    return model.selector_index({
        "customer": (customer, "c_custkey", "selector"),
        "nation": (_read(spark, d, "nation"), "n_nationkey", "n_name"),
        "supplier": (_read(spark, d, "supplier"), "s_suppkey", "s_name"),
    })


@_query(
    "compared_together",
    "with l as (select distinct c_nationkey::bigint as k from customer where c_acctbal > 9000 union select p_size from part), r as (select distinct s_nationkey::bigint as k from supplier union select l_linenumber * 10 from lineitem) "
    "select coalesce(l.k, r.k) as k, case when r.k is null then 'left' when l.k is null then 'right' else 'both' end as side from l full join r on l.k = r.k",
)
def _together(spark, d):
    k = lambda t, c: _read(spark, d, t).select(c.cast("long").alias("k"))
    left = [_read(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").cast("long").alias("k")), k("part", F.col("p_size"))]
    return model.compared_together(left, [k("supplier", F.col("s_nationkey")), k("lineitem", F.col("l_linenumber") * 10)], "k")


@_query("rows_of_source", "select doc_id, source, lang from documents where (source, lang) in (select source, lang from documents group by 1, 2 having count(*) >= 20)")
def _of_source(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", "source", "lang")
    big = docs.groupBy("source", "lang").count().where("count >= 20")
    return model.of_source(docs, big, ["source", "lang"])


_TABLES = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "events": ["event_id", "user_id"], "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id"],
}


@_query(
    "declared_columns",
    " union all ".join(f"select '{t}' as \"table\", '{c}' as \"column\", {c != 'user_id'} as declared, count({c}) as rows from {t}" for t, cs in _TABLES.items() for c in cs),
)
def _declared(spark, d):
    """Columns of the tables that look like keys, and whether the catalog has them as keys."""
    catalog = testdata(spark, d)
    keys = [(e.name, e.id) for e in catalog.entities.values()] + [(x, k) for r in catalog.relations.values() for x, k in ((r.source, r.source_key), (r.target, r.target_key))]
    declared = spark.createDataFrame([(t.upper(), c) for t, c in keys], "`table` string, `column` string")
    found = catalogues.observed_columns({t: catalog.rows(t) for t in _TABLES})
    return model.declared_columns(found, declared).join(found, ["table", "column"])


@_query("sample_binding", "select p_brand, count(*) as n from part where p_size > 10 group by 1 order by n desc, p_brand limit 1")
def _binding(spark, d):
    return model.sample_binding(_read(spark, d, "part"), "p_brand", F.col("p_size") > 10)


@_query("first_seen", "select user_id, event_type, min(ts) as first_ts, arg_min(event_id, (ts, event_id)) as first_event_id from events group by 1, 2")
def _first_seen(spark, d):
    return model.first_seen(_read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@_query("queue_position", "select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as position from orders where o_orderstatus = 'O'")
def _queue(spark, d):
    return model.queue_positions(_read(spark, d, "orders"), F.col("o_orderstatus") == "O", ["o_orderdate", "o_orderkey"], "o_custkey").select("o_orderkey", "o_custkey", "position")


@_query("composite_order", "select p_partkey, p_brand, case when p_size > 10 then p_size end as n from part order by coalesce(case when p_size > 10 then p_size end, 0), p_partkey")
def _composite(spark, d):
    part = _read(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 10, F.col("p_size")).alias("n"))
    return model.composite_order(part, {"n": 0, "p_partkey": 0})


@_query("unknown_parameters", "select distinct o_custkey as name from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def _parameters(spark, d):
    used = _read(spark, d, "orders").select(F.col("o_custkey").alias("name"))
    return model.unknown_parameters(used, _read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("name")), ["name"])


@_query(
    "batch_status",
    "select l_orderkey, count(*) as commands, sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint as failed, "
    "case when failed = 0 then 'succeeded' when failed = count(*) then 'failed' else 'partiallySucceeded' end as status from lineitem group by 1",
)
def _batches(spark, d):
    return model.batch_status(_read(spark, d, "lineitem"), "l_orderkey", F.col("l_returnflag") != "R")


@_query("apply_phases", "select l_orderkey, l_linenumber, l_returnflag as operation, case l_returnflag when 'N' then 1 when 'A' then 2 end as phase from lineitem")
def _phases(spark, d):
    li = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("operation"))
    return model.apply_phases(li, "operation", {"N": 1, "A": 2})


@_query(
    "read_back",
    "with r as (select p_partkey, case when p_size % 2 = 0 then p_size + (p_partkey % 3)::int end as p_size, case when p_size % 5 = 0 then p_brand end as p_brand from part), "
    "q as (select p_partkey, 'p_size' as property, p_size::varchar as requested from r union all select p_partkey, 'p_brand', p_brand from r), "
    "a as (select p_partkey, 'p_size' as property, p_size::varchar as actual from part union all select p_partkey, 'p_brand', p_brand from part) "
    "select q.p_partkey, property, requested, actual, requested is not distinct from actual as applied from q join a using (p_partkey, property) where requested is not null",
)
def _read_back(spark, d):
    part = _read(spark, d, "part")
    asked = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size") + (F.col("p_partkey") % 3).cast("int")).alias("p_size"), F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).alias("p_brand"))
    return model.read_back(asked, part, "p_partkey", ["p_size", "p_brand"])


@_query(
    "remapped_ids",
    "with m as (select o_orderkey * 2 as old, o_orderkey + 1000000 as new from orders) "
    "select coalesce(a.new, o_orderkey) as id, coalesce(b.new, o_custkey) as target from orders left join m a on a.old = o_orderkey left join m b on b.old = o_custkey",
)
def _remap(spark, d):
    orders = _read(spark, d, "orders")
    ids = orders.select((F.col("o_orderkey") * 2).alias("old"), (F.col("o_orderkey") + 1000000).alias("new"))
    return model.remapped(orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("target")), ids)


@_query(
    "current_records",
    "with v as (select * from events where event_type <> 'error'), l as (select user_id, max(date_trunc('day', ts)) as day from v group by 1), "
    "m as (select v.user_id, count(*) as n, min(event_id) as e from v join l on v.user_id = l.user_id and date_trunc('day', v.ts) = l.day group by 1) "
    "select user_id, case when n = 1 then e end as event_id, n > 1 as ambiguous from m",
)
def _current(spark, d):
    events = _read(spark, d, "events").select("event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("day"))
    out = model.current_records(events, "user_id", F.col("event_type") != "error", "day")
    return out.select("user_id", F.col("record.event_id").alias("event_id"), "ambiguous")


_GRAPH = "select p_partkey as src, (p_partkey * 7 + 3) % 500 as dst from part"


@_query("workflow_reach", f"with recursive e as ({_GRAPH}), r as (select 1::bigint as node union select dst from e join r on src = node) select node from r")
def _reach(spark, d):
    edges = _read(spark, d, "part").select(F.col("p_partkey").alias("src"), ((F.col("p_partkey") * 7 + 3) % 500).alias("dst"))
    return model.reachable(edges, spark.createDataFrame([(1,)], "node long"))


for _name in ("missing", "extra", "mismatched_types", "mismatched_values", "equivalent"):
    _tests = {
        "missing": "r.k is null", "extra": "l.k is null", "mismatched_types": "l.k is not null and r.k is not null and l.t is distinct from r.t",
        "mismatched_values": "l.k is not null and r.k is not null and l.t is not distinct from r.t and l.v is distinct from r.v",
        "equivalent": "l.k is not null and r.k is not null and l.t is not distinct from r.t and l.v is not distinct from r.v",
    }

    @_query(
        f"comparison_{_name}",
        "with l as (select p_partkey as k, p_size as v, p_type as t from part), r as (select p_partkey + 10 as k, case when p_partkey % 4 = 0 then 1 else (select any_value(q.p_size) from part q where q.p_partkey = p.p_partkey + 10) end as v, "
        "case when p_partkey % 3 = 0 then 'OTHER' else (select any_value(q.p_type) from part q where q.p_partkey = p.p_partkey + 10) end as t from part p) "
        f"select coalesce(l.k, r.k) as k, l.v as left_value, l.t as left_kind, r.v as right_value, r.t as right_kind from l full join r on l.k = r.k where {_tests[_name]}",
    )
    def _comparison(spark, d, name=_name):
        part = _read(spark, d, "part")
        left = part.select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"), F.col("p_type").alias("t"))
        moved = part.select((F.col("p_partkey") + 10).alias("k"), F.col("p_partkey").alias("p")).join(left, "k", "left")
        right = moved.select("k", F.when(F.col("p") % 4 == 0, 1).otherwise(F.col("v")).alias("v"), F.when(F.col("p") % 3 == 0, "OTHER").otherwise(F.col("t")).alias("t"))
        return model.comparison_views(left, right, "k", "v", "t")[name]


@_query(
    "catalogue_of_systems",
    "with a as (select distinct o_custkey from orders where o_totalprice > 200000) "
    "select c_custkey as id, c_name as caption, o_custkey is not null as authorable, case when o_custkey is null then 'no order above the limit' end as reason from customer left join a on o_custkey = c_custkey",
)
def _systems(spark, d):
    index = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("caption"))
    pack = _read(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("id"))
    return model.catalogue_of_systems(index, pack, "no order above the limit")


@_query(
    "capabilities",
    "with c as (select distinct l_returnflag || l_linestatus as capability, x as family from lineitem, (values ('A'), ('N'), ('R')) v(x)), f as (select distinct l_returnflag || l_linestatus as capability, l_returnflag as family from lineitem where l_quantity > 49) "
    "select capability, count(*) as families, count(f.family) as shown, case when shown = families then 'confirmed' when shown > 0 then 'partial' else 'unconfirmed' end as status from c left join f using (capability, family) group by 1",
)
def _capabilities(spark, d):
    li = _read(spark, d, "lineitem").withColumn("capability", F.concat("l_returnflag", "l_linestatus"))
    declared = li.select("capability").distinct().withColumn("family", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))))
    return model.capabilities(declared, li.where("l_quantity > 49").select("capability", F.col("l_returnflag").alias("family")))


@_query("unsupported_inferences", "select o_orderkey from orders where o_orderstatus = 'P' and o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)")
def _inferences(spark, d):
    return model.unsupported_inferences(_read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), _read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", F.col("o_orderstatus") == "P").select("o_orderkey")


@_query(
    "contract_rows",
    "with g as (select distinct p_brand as property, p_type as \"group\" from part where p_size > 45) select n as property, count(\"group\") as groups_of, min(\"group\") as \"group\" from (select distinct p_brand as n from part) left join g on property = n group by 1",
)
def _contract(spark, d):
    part = _read(spark, d, "part")
    groups = part.where("p_size > 45").select(F.col("p_brand").alias("property"), F.col("p_type").alias("group")).distinct()
    return model.contract_rows(part.select(F.col("p_brand").alias("property")).distinct(), groups)


@_query("provenance_header", "select r_regionkey, 'legacy' as _source, 'a/b' as _path, 'Confirmed' as _confidence from region")
def _provenance(spark, d):
    return model.with_provenance(_read(spark, d, "region").select("r_regionkey"), "legacy", "a/b", "Confirmed")


@_query(
    "scope_locks",
    f"with s as (select o_orderkey as task, {_STATUS} as state from orders), h as (select distinct l_orderkey as task, l_partkey as scope from lineitem) "
    "select scope, count(*) as tasks from h join s using (task) where state not in ('integrated', 'cancelled', 'abandoned') group by 1 having count(*) > 1",
)
def _locks(spark, d):
    states = _read(spark, d, "orders").select(F.col("o_orderkey").alias("task"), F.expr(_STATUS).alias("state"))
    return workflow.scope_conflicts(_read(spark, d, "lineitem").select(F.col("l_orderkey").alias("task"), F.col("l_partkey").alias("scope")), states)


@_query(
    "voided_transitions",
    "with e as (select user_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as back, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) "
    "select user_id, event_type as \"from\", back as \"to\" from e where rn = 1 and back is not null",
)
def _voided(spark, d):
    return workflow.voided(_read(spark, d, "events"), "user_id", "event_type", ["ts", "event_id"])


@_query("log_tail", "select event_id, ts, event_type from events order by ts desc, event_id desc limit 400")
def _tail(spark, d):
    return workflow.tail(_read(spark, d, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"])


@_query("json_path_samples", "select '$' as path, array_to_string(list_sort(list(event_id))[1:5], ',') as samples from events union all select '$.k', array_to_string(list_sort(list(event_id))[1:5], ',') from events where json_extract(props, '$.k') is not null")
def _path_samples(spark, d):
    out = jsonwalk.path_catalogue(jsonwalk.walk(_read(spark, d, "events"), "event_id", "props"))
    return out.select("path", F.array_join("samples", ",").alias("samples"))


@_query(
    "mixed_array_types",
    "select 'A' as type, count(*) as objects, '$type,a' as keys from lineitem where l_returnflag = 'A' union all select 'N', count(*), '$type,n' from lineitem where l_returnflag = 'N' union all select 'R', count(*), '$type' from lineitem where l_returnflag = 'R'",
)
def _mixed(spark, d):
    flag = F.col("l_returnflag")
    item = F.struct(flag.alias("$type"), F.when(flag == "A", F.col("l_linenumber")).alias("a"), F.when(flag == "N", F.col("l_linenumber")).alias("n"))
    docs = _read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(item)).alias("doc"))
    out = jsonwalk.type_catalogue(jsonwalk.walk(docs, "l_orderkey", "doc", type_key="$type"))
    return out.withColumn("keys", F.array_join("keys", ","))
