"""Event time: windows, joins within an interval, late rows beside the rest, and sinks that write a batch once.

Windows and interval joins take tables and streams alike; the stream's result, when its input has ended, is the table's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..errors import SpecError
from .workflow import _fs


def windowed(events: DataFrame, at: str, keys: list[str], width: str, slide: str | None = None, delay: str | None = None, **aggregates: Column) -> DataFrame:
    """(start, end, keys, aggregates) of event-time windows; each event is in every window [start, end) that holds its time.

    delay is the watermark of a stream: a window is final, and goes out in append mode, when an event that is later than its end
    by more than delay has come. Events without a time are in no window.
    """
    if not aggregates:
        raise SpecError("windows need an aggregate")
    rows = events.withWatermark(at, delay) if delay else events
    grouped = rows.groupBy(F.window(at, width, slide).alias("_w"), *keys).agg(*(a.alias(n) for n, a in aggregates.items()))
    return grouped.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, *aggregates)


def interval_join(left: DataFrame, right: DataFrame, key: str, at: str, seconds: int, delay: str | None = None) -> DataFrame:
    """Pairs of left and right rows of one key where right's time is from left's on to seconds later, both ends included.

    Columns are left_ and right_ and their names. Rows meet by key and a span of time of that length, so that all rows of a hot key don't
    meet in one task: a left row goes to the two spans that its interval reaches. delay is the watermark of both streams,
    after which a row that nothing can meet any more is forgotten. NULL keys and times meet nothing.
    """
    if seconds < 1:
        raise SpecError("an interval has a second at least")
    a = left.select(*(F.col(c).alias(f"left_{c}") for c in left.columns))
    b = right.select(*(F.col(c).alias(f"right_{c}") for c in right.columns))
    if delay:
        a, b = a.withWatermark(f"left_{at}", delay), b.withWatermark(f"right_{at}", delay)
    span = lambda c: F.floor(F.col(c).cast("timestamp").cast("double") / seconds).cast("long")
    a = a.withColumn("_span", F.explode(F.array(span(f"left_{at}"), span(f"left_{at}") + 1)))
    b = b.withColumn("_of", span(f"right_{at}"))
    near = (F.col(f"right_{at}") >= F.col(f"left_{at}")) & (F.col(f"right_{at}") <= F.col(f"left_{at}") + F.expr(f"interval {seconds} seconds"))
    return a.join(b, (F.col(f"left_{key}") == F.col(f"right_{key}")) & (F.col("_span") == F.col("_of")) & near).drop("_span", "_of")


def consumed(events: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """(keys, columns) of the first event of each attempt, by order: all later ones with its keys are repeats. NULL is a key."""
    return events.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")).select(*keys, *(F.col(f"_first.{c}").alias(c) for c in columns))


# Sinks: a folder for each micro-batch, whole or not there


def _batch(path: str, number: int) -> str:
    return f"{path}/batch={number:012d}"


def _whole(spark: SparkSession, path: str, number: int) -> bool:
    return _fs(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(f"{_batch(path, number)}/_SUCCESS"))


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The batches that were written whole, the oldest first."""
    at, fs = spark._jvm.org.apache.hadoop.fs.Path(path), _fs(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in (int(x.removeprefix("batch=")) for x in found if x.startswith("batch=")) if _whole(spark, path, n))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all whole batches; what a crash has left behind is not read."""
    paths = [_batch(path, n) for n in numbers(spark, path)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def writes_once(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a batch whose number has been written whole is ignored, so a replayed one changes nothing."""

    def write(rows: DataFrame, number: int) -> None:
        if _whole(rows.sparkSession, path, number):
            rows.write.format("noop").mode("overwrite").save()  # the state of what stands before has to be made anew all the same
        else:
            rows.write.mode("overwrite").parquet(_batch(path, number))

    return write


def consume(attempts: DataFrame, keys: list[str], at: str, delay: str, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer that takes each attempt once: repeats within the watermark go, with state bounded by delay, and a batch
    that is replayed after a crash is written once. read_batches(path) gives the attempts."""
    fresh = attempts.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)
    return fresh.writeStream.foreachBatch(writes_once(path)).option("checkpointLocation", checkpoint)


def split_late(events: DataFrame, at: str, delay_seconds: int, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer of path/on_time and path/late: a row is late if it is more than the delay behind the latest time of the batches before.

    Spark's own watermark drops such rows without a word. The mark is kept with each batch (path/mark) and read from
    the one before, so a replayed batch is split as it was. Rows without a time are late.
    """

    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        if _whole(spark, f"{path}/mark", number):
            rows.write.format("noop").mode("overwrite").save()
            return
        done = [n for n in numbers(spark, f"{path}/mark") if n < number]
        before = spark.read.parquet(_batch(f"{path}/mark", done[-1])).first()[0] if done else None
        behind = F.lit(False) if before is None else F.col(at) < F.lit(before) - F.expr(f"interval {delay_seconds} seconds")
        late = F.col(at).isNull() | behind
        rows = rows.persist()
        rows.where(~late).write.mode("overwrite").parquet(_batch(f"{path}/on_time", number))
        rows.where(late).write.mode("overwrite").parquet(_batch(f"{path}/late", number))
        mark = F.max(at) if before is None else F.greatest(F.max(at), F.lit(before))
        rows.agg(mark.alias("mark")).write.mode("overwrite").parquet(_batch(f"{path}/mark", number))
        rows.unpersist()

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
