"""Chained record signs: each row's hash takes in the hash of the row before, so a changed row breaks all that follow."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..errors import SpecError

#: Rows that are signed at once.
SLICE = 4096


def message(salt: str, fields: list[str]) -> Column:
    """What is signed of a row: salt, and each field as length:text, or - for NULL, so that no two rows read alike."""
    text = lambda c: F.col(c).cast("string")
    return F.concat(F.lit(salt), *(F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c))) for c in fields))


def chained(rows: DataFrame, key: str, order: list[str], fields: list[str], salt: str, name: str = "sign") -> DataFrame:
    """rows with name: the sha256 of the sign before, in the order of the key's rows, and the row's own message.

    The first row of a key has an empty sign before it; NULL is a key. order must tell the rows of a key apart. A key's rows are
    sorted by the shuffle and pass one task as a stream, which holds the last sign and never the key's rows.
    """
    if name in rows.columns:
        raise SpecError(f"rows have a column {name} already")
    columns, width = rows.columns, len(rows.columns)
    ready = rows.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit(""))).withColumn("_null", F.col(key).isNull()).withColumn("_message", message(salt, fields))
    ready = ready.repartition("_key", "_null").sortWithinPartitions("_null", "_key", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sign = None, ""
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                keys, nulls, messages = (part.column(width + k).to_pylist() for k in range(3))
                out = []
                for k, null, m in zip(keys, nulls, messages, strict=True):
                    if (k, null) != last:
                        last, sign = (k, null), ""
                    sign = hashlib.sha256((sign + m).encode()).hexdigest()
                    out.append(sign)
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(out, pa.string())], names=[*columns, name])

    return ready.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def verified(signed: DataFrame, key: str, order: list[str], fields: list[str], salt: str, name: str = "sign") -> DataFrame:
    """signed with link and chain: whether a row's sign fits its own text and the sign stored before it, and whether
    it fits all rows before it too. The first row of a key whose link is broken is where it was changed; its chain and all after it are broken.
    """
    by = Window.partitionBy(key).orderBy(*order)
    before = F.coalesce(F.lag(name).over(by), F.lit(""))
    out = signed.withColumn("link", F.col(name).eqNullSafe(F.sha2(F.concat(before, message(salt, fields)), 256)))
    anew = chained(out, key, order, fields, salt, "_anew")
    return anew.withColumn("chain", F.col(name).eqNullSafe(F.col("_anew"))).drop("_anew")
