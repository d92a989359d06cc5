"""An append-only event log and the guarded state machine of tasks that it describes, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import SpecError

#: The transitions that each state allows, and the states in which a task holds no scope. From blocked
#: a task may also return to the state before it.
EDGES = {
    "new": ["architecture", "blocked", "cancelled"],
    "architecture": ["ready", "needs-clarification", "needs-investigation", "blocked", "cancelled"],
    "needs-clarification": ["architecture", "new", "cancelled", "abandoned"],
    "needs-investigation": ["architecture", "blocked"],
    "ready": ["implementing", "blocked", "cancelled"],
    "implementing": ["review", "failed", "architecture", "blocked"],
    "review": ["approved", "rejected", "failed", "blocked"],
    "rejected": ["implementing", "architecture", "blocked"],
    "failed": ["architecture", "blocked"],
    "approved": ["integrating", "blocked"],
    "integrating": ["integrated", "conflict", "blocked", "implementing", "architecture"],
    "conflict": ["implementing", "blocked"],
    "blocked": ["cancelled", "abandoned"],
}
BACK = "blocked"
TERMINAL = RELEASED = ("integrated", "cancelled", "abandoned")
#: About how many held scopes one task joins at once.
HELD_ROWS = 500_000
EVENT_SCHEMA = "at timestamp, task string, event string, `from` string, `to` string, note string, _corrupt string"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of a log; a bad line is a row whose _corrupt holds it."""
    return spark.read.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def stream_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def append_events(events: DataFrame, path: str) -> None:
    events.select(F.to_json(F.struct(*events.columns)).alias("value")).write.mode("append").text(path)


def edge_rows(spark: SparkSession, edges: dict[str, list[str]] | None = None) -> DataFrame:
    """(src, dst) of the transitions that need no history."""
    rows = [(a, b) for a, bs in (EDGES if edges is None else edges).items() for b in bs]
    return spark.createDataFrame(rows, "src string, dst string")


def transitions(events: DataFrame, key: str, state: str, order: list[str], edges: DataFrame, back: str | None = None) -> DataFrame:
    """events with previous state and legal: whether the edge is known; from back a task may also return to the state before it.

    The first event of a key is legal. A key's events are ordered by one task; a key is one task's history.
    """
    w = Window.partitionBy(key).orderBy(*order)
    seen = events.withColumn("previous", F.lag(state).over(w)).withColumn("before", F.lag(state, 2).over(w))
    known = F.broadcast(edges.select(F.col("src").alias("_s"), F.col("dst").alias("_d"), F.lit(True).alias("_k")))
    j = seen.join(known, (F.col("previous") == F.col("_s")) & (F.col(state) == F.col("_d")), "left")
    legal = F.col("previous").isNull() | F.col("_k").isNotNull()
    if back:
        legal = F.when(F.col("previous") == back, legal | F.col(state).eqNullSafe(F.col("before"))).otherwise(legal)
    return j.withColumn("legal", legal).drop("_s", "_d", "_k", "before")


def latest(events: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """The last row of each key by order: a maximum, so that no key's rows gather in one task."""
    return events.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("last")).select(key, "last.*")


def budget(events: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """events with used: how many of its keys' events came up to it; exceeded once used is over most."""
    used = F.count("*").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return events.withColumn("used", used).withColumn("exceeded", F.col("used") > most)


def sessions(events: DataFrame, key: str, at: str, gap: str = "10 minutes") -> DataFrame:
    """An extension: sessions of a key's events, by gap."""
    return events.groupBy(key, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("events")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")


def run_state_machine(stream: DataFrame, edges: dict[str, list[str]] | None = None) -> DataFrame:
    """(task, at, state, accepted, reason): each event judged in the order of arrival, with the state kept for each task.

    An illegal transition is reported and changes nothing. blocked also leads back to the state before it.
    """
    edges = EDGES if edges is None else edges
    out = "task string, at timestamp, state string, accepted boolean, reason string"

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now, before = state.get if state.exists else (None, None)
        rows = []
        for f in frames:
            for at, to in f.sort_values("at")[["at", "to"]].itertuples(index=False):
                if now is None:
                    ok = to == "new"
                else:
                    ok = to in edges.get(now, ()) or now == BACK and to == before
                rows.append((key[0], at, to, ok, None if ok else f"{now} -> {to}"))
                if ok:
                    now, before = to, now
        state.update((now, before))
        yield pd.DataFrame(rows, columns=["task", "at", "state", "accepted", "reason"])

    changed = stream.where("event = 'state.changed' and task is not null and `to` is not null").select("task", "at", "to")
    return changed.groupBy("task").applyInPandasWithState(step, out, "now string, before string", "append", "NoTimeout")


def deduplicated(stream: DataFrame, keys: list[str], at: str, delay: str = "1 hour") -> DataFrame:
    """Each attempt is consumed once within the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def _version(path: str, number: int) -> str:
    return f"{path}/version={number:012d}"


def _fs(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The whole versions of a board, the oldest first."""
    at, fs = spark._jvm.org.apache.hadoop.fs.Path(path), _fs(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def read_board(spark: SparkSession, path: str) -> DataFrame:
    """(task, at, state) of the last whole version."""
    known = _versions(spark, path)
    if not known:
        raise SpecError(f"no board at {path}")
    return spark.read.parquet(_version(path, known[-1]))


def scope_conflicts(held: DataFrame, states: DataFrame) -> DataFrame:
    """(scope, tasks): scopes of held(task, scope) that several tasks hold at once; states(task, state) in RELEASED hold nothing."""
    held = held.select("task", "scope")
    # partitions by a number that grows with the rows, which adaptive plans keep: neither the join nor the distinct rows hold more in one task.
    # Fewer than the session's own would be shuffled again
    parts = max(held.count() // HELD_ROWS + 1, int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    mine = states.where(~F.col("state").isin(*RELEASED)).select("task").repartition(parts, "task")
    holding = held.repartition(parts, "task").join(mine.hint("merge"), "task", "left_semi")
    return holding.distinct().groupBy("scope").agg(F.count("*").alias("tasks")).where("tasks > 1")


def voided(events: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    """The compensating event of each key's last one, (key, from, to): back to the state before; a first event cannot be undone."""
    w = Window.partitionBy(key).orderBy(*order)
    last = Window.partitionBy(key).orderBy(*(F.desc(o) for o in order))
    seen = events.withColumn("to", F.lag(state).over(w)).withColumn("_rn", F.row_number().over(last))
    return seen.where("_rn = 1 and `to` is not null").select(key, F.col(state).alias("from"), "to")


def tail(lines: DataFrame, order: list[str], most: int = 400) -> DataFrame:
    """The last lines of a log, oldest first: a top-k, not a sort of all."""
    return lines.orderBy(*(F.desc(o) for o in order)).limit(most).orderBy(*order)


def board(stream: DataFrame, path: str, checkpoint: str):
    """Keep a small table of the tasks' last accepted states: a folder for each batch, read by read_board().

    A version is whole once its _SUCCESS stands; a batch builds on the last whole one before it, so neither a failed read
    nor a crash loses the board, and a batch that runs again writes the same version. The one before is kept, older ones go.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.where("accepted").groupBy("task").agg(F.max_by(F.struct("at", "state"), "at").alias("l")).select("task", "l.*")
        known = [v for v in _versions(spark, path) if v < number]
        old = spark.read.parquet(_version(path, known[-1])) if known else new.limit(0)
        both = old.unionByName(new).groupBy("task").agg(F.max_by(F.struct("at", "state"), "at").alias("l")).select("task", "l.*")
        both.write.mode("overwrite").parquet(_version(path, number))
        for v in known[:-1]:
            _fs(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(_version(path, v)), True)

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
