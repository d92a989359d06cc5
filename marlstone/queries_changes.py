"""Change batches, signatures, schemas and shapes as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .operators import apply, jsonschema, shapes, signing
from .operators.tables import stored
from .queries import _order_json, _query, _read

# Applying: an order is a batch, its lines are commands; each line refers to the next one, the last to the first

_COMMANDS = (
    "with c as (select l_orderkey as batch_id, l_linenumber as pos, min(l_returnflag) as flag, max(l_discount) as discount, max(l_tax) as tax from lineitem group by 1, 2), "
    "n as (select *, lead(pos) over w as next_pos, first_value(pos) over w as head, case when flag = 'N' then 2 else 1 end as phase, (flag = 'R' and tax > 0.02) as tied from c window w as (partition by batch_id order by pos rows between unbounded preceding and unbounded following)), "
    "f as (select *, discount >= 0.09 as refused, tied and pos <> head as below, tied and pos = head as self from n), "
    "s as (select f.*, case when f.refused then 'refused' when f.self or (f.below and h.self) then 'cycle' when f.below and h.refused then 'dependency' else 'created' end as status from f join f h on h.batch_id = f.batch_id and h.pos = f.head), "
    "o as (select *, case when status = 'created' then row_number() over (partition by status = 'created' order by phase, batch_id, case when below then 1 else 0 end, pos) + 999 end as id from s) "
)


def _lines(spark, d):
    c = _read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("batch_id"), F.col("l_linenumber").alias("pos")).agg(F.min("l_returnflag").alias("flag"), F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    lines = Window.partitionBy("batch_id").orderBy("pos")  # the lines of one order
    c = c.withColumn("head", F.first("pos").over(lines)).withColumn("next", F.coalesce(F.lead("pos").over(lines), "head"))
    c = stored(c, "lines")  # commands, references and refusals are read from it many times
    temp = lambda p: F.concat(F.lit("t"), F.col(p).cast("string"))
    commands = c.select("batch_id", "pos", F.when(F.col("flag") == "N", apply.DYNAMIC).otherwise("field").alias("objectType"), temp("pos").alias("tempId"))
    tied = c.where("flag = 'R' and tax > 0.02").select("batch_id", "pos", F.lit("target").alias("field"), temp("head").alias("tempId"), F.lit(True).alias("structural"))
    after = c.select("batch_id", "pos", F.lit("next").alias("field"), temp("next").alias("tempId"), F.lit(False).alias("structural"))
    gone = c.where("pos = 2").select("batch_id", "pos", F.lit("view").alias("field"), F.lit("nowhere").alias("tempId"), F.lit(False).alias("structural"))
    return commands, tied.unionByName(after).unionByName(gone), c.where("discount >= 0.09").select("batch_id", "pos")


@_query("applied_objects", _COMMANDS + "select batch_id, pos, 't' || pos as \"tempId\", phase, id, status from o")
def _objects(spark, d):
    return apply.create(*_lines(spark, d), start=1000).drop("level")


@_query(
    "applied_references",
    _COMMANDS + ", r as (select batch_id, pos, id, 'next' as field, coalesce(next_pos, head) as to_pos from o union all select batch_id, pos, id, 'view', null from o where pos = 2) "
    "select r.batch_id, r.pos, r.field, case when r.field = 'view' then 'nowhere' else 't' || r.to_pos end as \"tempId\", case when r.id is not null then -1::bigint end as placeholder, case when r.id is not null then t.id end as value, "
    "case when r.id is null then 'no_row' when t.pos is null then 'missing' when t.id is null then 'unresolved' else 'resolved' end as state, case r.field when 'view' then 1 else 0 end as step, true as ordered "
    "from r left join o t on t.batch_id = r.batch_id and t.pos = r.to_pos",
)
def _references(spark, d):
    commands, references, refused = _lines(spark, d)
    order = spark.createDataFrame([(k, "view", "next") for k in ("field", apply.DYNAMIC)], "objectType string, field string, needs string")
    return apply.ledger(apply.create(commands, references, refused, start=1000), commands, references, order)

# Signatures: the events of a user as a chain

_MESSAGE = "'salt' || " + " || ".join(f"case when {c} is null then '-' else length({c}::varchar) || ':' || {c}::varchar end" for c in ("event_id", "event_type", "props"))


@_query(
    "chained_signs",
    f"with recursive e as (select event_id, user_id, {_MESSAGE} as m, row_number() over (partition by user_id order by ts, event_id) as n from events), "
    "s as (select event_id, user_id, n, sha256(m) as sign from e where n = 1 union all select e.event_id, e.user_id, e.n, sha256(s.sign || e.m) from s join e on e.user_id = s.user_id and e.n = s.n + 1) "
    "select event_id, user_id, sign from s",
)
def _signs(spark, d):
    events = _read(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "props")
    return signing.chained(events, "user_id", ["ts", "event_id"], ["event_id", "event_type", "props"], "salt").select("event_id", "user_id", "sign")

# JSON schemas: orders with their lines, and the properties of events

_LINE = {"type": "object", "required": ["id", "flag", "note"], "additionalProperties": False, "properties": {"id": {"type": "integer", "maximum": 5}, "flag": {"enum": ["A", "N"]}, "$type": {"const": "line"}, "note": True}}
_ORDER = {
    "type": "object",
    "properties": {"id": {"type": "integer", "minimum": 100}, "status": {"$ref": "#/$defs/status"}, "lines": {"type": "array", "maxItems": 4, "items": {"$ref": "#/$defs/line"}}},
    "additionalProperties": False,
    "$defs": {"line": _LINE, "status": {"type": "string", "pattern": "^[FO]$"}},
}


@_query(
    "schema_findings",
    "with l as (select l_orderkey, l_linenumber, l_returnflag, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag) - 1 as i from lineitem where l_orderkey in (select o_orderkey from orders)), "
    "n as (select l_orderkey, count(*) as n from l group by 1) "
    "select o_orderkey, '$' as place, 'additionalProperties' as rule, '$type' as detail from orders join n on l_orderkey = o_orderkey "
    "union all select o_orderkey, '$.id', 'minimum', '100, it is ' || o_orderkey from orders join n on l_orderkey = o_orderkey where o_orderkey < 100 "
    "union all select o_orderkey, '$.status', 'pattern', '^[FO]$' from orders join n on l_orderkey = o_orderkey where not regexp_matches(o_orderstatus, '^[FO]$') "
    "union all select l_orderkey, '$.lines', 'maxItems', '4, it has ' || n from n where n > 4 "
    "union all select l_orderkey, '$.lines[' || i || ']', 'required', 'note' from l "
    "union all select l_orderkey, '$.lines[' || i || '].id', 'maximum', '5, it is ' || l_linenumber from l where l_linenumber > 5 "
    "union all select l_orderkey, '$.lines[' || i || '].flag', 'enum', l_returnflag from l where l_returnflag not in ('A', 'N')",
)
def _schema(spark, d):
    return jsonschema.findings(_order_json(spark, d), "o_orderkey", "doc", _ORDER)


@_query("schema_of_events", "select event_id, '$.k' as place, 'anyOf' as rule, 'none of the alternatives fits' as detail from events where json_extract(props, '$.k')::bigint between 30 and 60")
def _schema_events(spark, d):
    return jsonschema.findings(_read(spark, d, "events"), "event_id", "props", {"required": ["k"], "properties": {"k": {"type": "integer", "anyOf": [{"exclusiveMaximum": 30}, {"exclusiveMinimum": 60}]}}})

# Shapes of types, over the lines of all orders

@_query(
    "type_shapes",
    "with l as (select l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus from lineitem join orders on l_orderkey = o_orderkey), "
    "o as (select count(distinct l_orderkey) as n, count(distinct case when l_returnflag <> 'R' then l_orderkey end) as flagged from l), c as (select count(*) as n, count(case when l_returnflag <> 'R' then 1 end) as flagged from l) "
    "select * from (select 'order' as type, '$type' as path, 'string' as kinds, n as objects, n as present, false as optional, false as repeated, false as nullable, 'order' as vocabulary from o "
    "union all select 'order', 'id', 'number', n, n, false, false, false, null from o union all select 'order', 'lines', 'array', n, n, false, false, false, null from o union all select 'order', 'lines[*]', 'object', n, n, false, true, false, null from o "
    "union all select 'line', '$type', 'string', n, n, false, false, false, 'line' from c union all select 'line', 'flag', 'string', n, flagged, flagged < n, false, false, 'A,N' from c "
    "union all select 'line', 'by.mode', 'string', n, n, false, false, false, (select string_agg(distinct l_linestatus, ',' order by l_linestatus) from l) from c union all select 'line', 'by', 'object', n, n, false, false, false, null from c "
    "union all select 'line', 'sizes', 'array', n, n, false, false, false, null from c union all select 'line', 'sizes[*]', 'number,string', n, n, false, true, false, null from c)",
)
def _shapes(spark, d):
    li = _read(spark, d, "lineitem")
    line = F.concat(
        F.lit('{"$type": "line", "sizes": ['), F.col("l_quantity").cast("string"), F.lit(', "L", 7], "by": {"mode": "'), F.col("l_linestatus"), F.lit('"}'),
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit(', "flag": "'), F.col("l_returnflag"), F.lit('"'))).otherwise(""), F.lit("}"),
    )
    li = li.join(_read(spark, d, "orders").select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))  # before there are texts, which are longer
    docs = li.groupBy("o_orderkey").agg(F.array_join(F.array_sort(F.collect_list(line)), ", ").alias("lines"))  # the lines of one order
    docs = docs.select("o_orderkey", F.concat(F.lit('{"$type": "order", "id": '), F.col("o_orderkey").cast("string"), F.lit(', "lines": ['), F.col("lines"), F.lit("]}")).alias("doc"))
    out = shapes.type_shapes(docs, "o_orderkey", "doc")
    return out.withColumn("kinds", F.array_join("kinds", ",")).withColumn("vocabulary", F.array_join("vocabulary", ","))
