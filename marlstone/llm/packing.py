"""Packing by power-of-two decomposition: no sequence crosses documents, and none needs padding.

A document of n ids is cut into pieces whose lengths are n's binary digits, the largest first, with as
many pieces of the full length as it takes. Each piece is a sequence of its own; equal lengths make a
bucket, from which a trainer draws batches of one shape. Sequences are numbered bucket by bucket, the longest
first, and within a bucket by document and place: a bucket is a range of numbers, the same on each run. Texts are
dealt by document, not ids by sequence, so the ids are written once and never shuffled.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import ByteCoder, coder
from .common import stored

LENGTH = 1024
END = 0

_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("place", pa.int64()), ("ids", pa.list_(pa.int32()))]


def lengths(n: int, most: int = LENGTH) -> list[int]:
    """Piece lengths of a document of n ids: most, most, ..., then falling powers of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, ids: bool = False) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A document's ids are those of its text, then end. length must be a power of two. A piece is a sequence
    (offset 0): its length is a power of two, so nothing is padded. sequence_id counts from 0 without gaps, by
    falling length, then id and start; rows that share an id follow each other by a hash of their texts. A last
    column bucket is the exponent of the length.

    Null text counts as empty: one piece, the end id. Repeated rows and null ids are packed like others. An
    empty table gives no rows. Other columns are ignored.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("length must be a power of two")
    fields = _FIELDS if ids else _FIELDS[:6]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ByteCoder, path)
        last = np.array([end], "<u4")
        places = Counter()  # of each length, in this range of documents
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                rows = []
                for doc, x in zip(part.column(0).to_pylist(), c.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    x = np.concatenate((x, last))
                    n, at = len(x), 0
                    for k in lengths(n, length):
                        piece = x[at : at + k].tobytes()
                        rows.append((doc, at, k, zlib.crc32(piece), n, places[k], piece))
                        places[k] += 1
                        at += k
                cols = [pa.array([r[k] for r in rows], fields[k][1]) for k in range(6)]
                if ids:
                    cols.append(pa.array([np.frombuffer(r[6], "<i4") for r in rows], fields[6][1]))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    # the last key parts rows that repeat, whose order means nothing, so that many of them still make even ranges
    order = ["doc_id", "hash", "row"]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    out = dealt.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long" + ", ids array<int>" * ids)
    return _numbered(out).withColumn("offset", F.lit(0).cast("long")).withColumn("bucket", F.log2("length").cast("int")).withColumnRenamed("doc_id", id_col)


def _numbered(pieces: DataFrame) -> DataFrame:
    """The pieces with their numbers: a piece's place of its length in its range of documents, after the counts before.

    Written once, as two readings of a range partitioning may draw different bounds.
    """
    made = stored(pieces.withColumn("part", F.spark_partition_id()), "pack-sequences", compression="zstd")
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    # a row for each partition and length, not for each piece
    before = counts.select("part", "length", (F.sum("n").over(Window.orderBy(F.desc("length"), "part")) - F.col("n")).alias("before"))
    placed = made.join(F.broadcast(before), ["part", "length"])
    # the columns in their places before the join
    return placed.withColumn("sequence_id", F.col("before") + F.col("place")).select(*(c for c in made.columns if c not in ("part", "place")), "sequence_id")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces by length: a folder for each bucket."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)
