"""Event-time operators as queries over the driver's events: the tables' side of what runs on streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from .queries import _query, _read
from .streaming import windows


@_query(
    "event_windows",
    "with w as (select event_type, value, unnest([b, b - interval 30 minutes]) as start from (select *, time_bucket(interval 30 minutes, ts) as b from events)) "
    'select start, start + interval 1 hour as "end", event_type, count(*) as n, sum(value::decimal(18,2))::double as total, max(value) as most from w group by 1, 2, 3',
)
def _windows(spark, d):
    e = _read(spark, d, "events")
    return windows.windowed(e, "ts", ["event_type"], "1 hour", "30 minutes", n=F.count("*"), total=F.sum(F.col("value").cast("decimal(18,2)")).cast("double"), most=F.max("value"))


@_query(
    "interval_pairs",
    "select a.event_id as click, b.event_id as purchase, a.user_id, date_diff('microsecond', a.ts, b.ts)::bigint as later from events a join events b on a.user_id = b.user_id and a.event_type = 'click' and b.event_type = 'purchase' and b.ts >= a.ts and b.ts <= a.ts + interval 6 hours",
)
def _pairs(spark, d):
    e = _read(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    met = windows.interval_join(e.where("event_type = 'click'"), e.where("event_type = 'purchase'"), "user_id", "ts", 6 * 3600)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return met.select(F.col("left_event_id").alias("click"), F.col("right_event_id").alias("purchase"), F.col("left_user_id").alias("user_id"), (micros("right_ts") - micros("left_ts")).alias("later"))
