"""Numbers and running totals in an order over all rows, without one task for all of them.

Range partitions number their own rows; what stands before a partition comes from a table with a row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .tables import stored


def _order(order: list[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def totalled(rows: DataFrame, order: list[str | Column], value: Column, name: str) -> DataFrame:
    """rows with name: the sum of value (a whole number, never NULL) over the rows before, in order. Equal rows in no stated order.

    The rows are shuffled once and summed up as they lie sorted. They are written once to the shared folder, as two
    readings of a range partitioning may draw different bounds.
    """
    by = _order(order)
    dealt = rows.withColumn("_range_value", value.cast("long")).repartitionByRange(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            upto = before + np.cumsum(values, dtype="<i8")
            if len(upto):
                before = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - values)], names=[*batch.schema.names, "_range_own"])

    schema = T.StructType([*dealt.schema.fields, T.StructField("_range_own", T.LongType())])
    ranged = stored(dealt.mapInArrow(run, schema).withColumn("_range_part", F.spark_partition_id()), "ranges")
    # a row for each partition, not for each row of data
    sums = ranged.groupBy("_range_part").agg(F.sum("_range_value").alias("_range_sum"))
    before = sums.select("_range_part", (F.sum("_range_sum").over(Window.orderBy("_range_part")) - F.col("_range_sum")).alias("_range_before"))
    return ranged.join(F.broadcast(before), "_range_part").withColumn(name, F.col("_range_before") + F.col("_range_own")).drop("_range_part", "_range_value", "_range_own", "_range_before")


def numbered(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """rows with name: their place in order, from 0, without gaps."""
    return totalled(rows, order, F.lit(1), name)
