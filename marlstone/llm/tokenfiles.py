"""Token ids as binary shard files of patched frame-of-reference blocks, and back.

A shard holds whole documents, in ascending order of their ids. All numbers are little-endian.

    "MPFR0001"                                  8 bytes
    blocks of up to BLOCK ids each:
        count u16, width u8, exceptions u16, minimum u32
        count offsets from the minimum, width bits each (ceil(count * width / 8) bytes); an exception has 0 here
        exceptions: u16 places, then u32 offsets
    directory, by document: id i64 each, then known u8 each (0: the id is null), then n_tokens u64 each
    block starts: u64 each
    footer: directory u64, block starts u64, documents u64, blocks u64, ids u64, "MPFR0001"

A block's width is that of the percentile of its offsets, and what does not fit is an exception. The starts make each
block of a shard readable on its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.tables import new_folder, remove
from .bpe import ByteCoder, coder
from .common import free, stored

BLOCK = 1024
END = 0
#: The share of a block's ids, in percent, that its width must hold; the others are exceptions.
PERCENTILE = 95
#: A shard is closed at the end of the document that takes it to so many ids.
SHARD_IDS = 1 << 24
#: Blocks that are written or read at once.
CHUNK = 256
#: Tasks that read shards, at most; with fewer shards there is one for each.
READ_TASKS = 20_000
#: Documents that are encoded at once.
DOCS = 200

MAGIC = b"MPFR0001"
_HEAD, _FOOT = struct.Struct("<HBHI"), struct.Struct("<5Q8s")


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of 1 to 65,535 ids below 2^32."""
    low = int(ids.min())
    off = (ids - low).astype("<u4")
    k = max(0, -(-len(off) * percentile // 100) - 1)
    width = int(np.partition(off, k)[k]).bit_length()
    odd = np.flatnonzero(off >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    fit = off.copy()
    fit[odd] = 0
    bits = np.unpackbits(fit.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits, bitorder="little").tobytes()
    return _HEAD.pack(len(ids), width, len(odd), low) + packed + odd.astype("<u2").tobytes() + off[odd].tobytes()


def decode_block(data: memoryview | bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The ids of the block at that place, as u32, and the place after it."""
    n, width, odd, low = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = -(-n * width // 8)
    out = np.zeros((n, 4), np.uint8)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little", count=n * width).reshape(n, width)
        packed = np.packbits(bits, axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
    off = out.view("<u4").ravel()
    at += size
    if odd:
        off[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return off + np.uint32(low), at + 6 * odd


class _Shard:
    """A shard that is being written: holds less than CHUNK blocks of ids, and the directory."""

    def __init__(self, folder: str, percentile: int) -> None:
        self.path, self.percentile = f"{folder}/{uuid.uuid4().hex}.pfr", percentile
        where, path = arrow_fs.FileSystem.from_uri(self.path)
        self.out = where.open_output_stream(path)
        self.out.write(MAGIC)
        self.at, self.ids = len(MAGIC), 0
        self.starts: list[int] = []
        self.docs: list[int] = []
        self.known: list[int] = []
        self.counts: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc or 0)
        self.known.append(doc is not None)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.ids += len(ids)
        if self.n_held >= CHUNK * BLOCK:
            self._write(self.n_held // BLOCK * BLOCK)

    def _write(self, n: int) -> None:
        held = np.concatenate(self.held) if self.held else np.empty(0, "<u4")
        for i in range(0, n, BLOCK):
            block = encode_block(held[i : min(i + BLOCK, n)], self.percentile)
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.held, self.n_held = [held[n:]], len(held) - n

    def close(self) -> None:
        self._write(self.n_held)
        directory = np.array(self.docs, "<i8").tobytes() + np.array(self.known, np.uint8).tobytes() + np.array(self.counts, "<u8").tobytes()
        self.out.write(directory)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(_FOOT.pack(self.at, self.at + len(directory), len(self.docs), len(self.starts), self.ids, MAGIC))
        self.out.close()


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, percentile: int = PERCENTILE, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the shards to folder, a URI that all executors see; the manifest: (part int, piece int, file string, n_ids long, n_docs long).

    The texts are dealt by ranges of their ids and encoded in order by the task that writes them. Shards in the
    order of (part, piece) hold the documents in ascending order of their ids, null ids first; equal ids stand in no
    stated order. A file counts if the manifest names it: what a lost or repeated task attempt has left is not named.
    The manifest is a stored table, with a row for each shard.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    # the row parts ids that repeat, so that many of them still make even ranges
    ranged = keyed.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select(F.spark_partition_id().alias("part"), "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, last = coder(ByteCoder, path), np.array([end], "<u4")
        shard, rows = None, []
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                number = part.column(0)[0].as_py()
                for doc, ids in zip(part.column(1).to_pylist(), c.encode(part.column(2).to_pylist()), strict=True):
                    shard = shard or _Shard(folder, percentile)
                    shard.add(doc, np.concatenate((ids, last)).astype("<u4", copy=False))
                    if shard.ids >= shard_ids:
                        shard.close()
                        rows.append((number, len(rows), shard.path, shard.ids, len(shard.docs)))
                        shard = None
        if shard:
            shard.close()
            rows.append((number, len(rows), shard.path, shard.ids, len(shard.docs)))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["part", "piece", "file", "n_ids", "n_docs"])

    return stored(ranged.mapInArrow(run, "part int, piece int, file string, n_ids long, n_docs long"), "token-manifest")


class Reader:
    """Reads a shard by its block starts."""

    def __init__(self, uri: str) -> None:
        where, path = arrow_fs.FileSystem.from_uri(uri)
        self.file = where.open_input_file(path)
        size = self.file.size()
        self.directory, self.index, self.n_docs, self.n_blocks, self.n_ids, magic = _FOOT.unpack(self._at(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError(f"no token file: {uri}")
        self.starts = np.append(np.frombuffer(self._at(self.index, 8 * self.n_blocks), "<u8").astype(np.int64), self.directory)

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def docs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, whether they are known, numbers of tokens."""
        n, data = self.n_docs, self._at(self.directory, 17 * self.n_docs)
        return np.frombuffer(data, "<i8", n), np.frombuffer(data, np.uint8, n, 8 * n), np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last - 1."""
        data, out, at = self._at(self.starts[first], int(self.starts[last] - self.starts[first])), [], 0
        for _ in range(first, last):
            ids, at = decode_block(data, at)
            out.append(ids)
        return np.concatenate(out) if out else np.empty(0, "<u4")

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from that place of the shard on; reads the blocks that hold them."""
        stop = min(start + n, self.n_ids)
        if stop <= start:
            return np.empty(0, "<u4")
        first = start // BLOCK
        return self.blocks(first, -(-stop // BLOCK))[start - first * BLOCK : stop - first * BLOCK]

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def _crcs(reader: Reader, counts: np.ndarray) -> np.ndarray:
    """The crc32 of each document's ids, with CHUNK blocks at a time."""
    out, ends = np.zeros(len(counts), np.int64), np.cumsum(counts)
    doc, at = 0, 0
    for b in range(0, reader.n_blocks, CHUNK):
        ids = reader.blocks(b, min(b + CHUNK, reader.n_blocks))
        data, base, stop = memoryview(ids.tobytes()), at, at + len(ids)
        while at < stop:
            to = min(int(ends[doc]), stop)
            out[doc] = zlib.crc32(data[4 * (at - base) : 4 * (to - base)], int(out[doc]))
            at = to
            doc += at == ends[doc]
    return out


def read(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32): a row for each document, all from the files that the manifest names.

    start counts the ids of all documents before it, in all shards. A task reads the shards that it was dealt, a
    few hundred blocks at a time.
    """
    order = Window.partitionBy("part").orderBy("piece")
    # sums by part first: the window over all parts has a row for each of them, not for each shard
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids_of_part"))
    before = parts.select("part", (F.sum("ids_of_part").over(Window.orderBy("part")) - F.col("ids_of_part")).alias("before"))
    placed = manifest.join(before, "part").select("file", (F.col("before") + F.sum("n_ids").over(order) - F.col("n_ids")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with Reader(file) as r:
                    docs, known, counts = r.docs()
                    cols = [pa.array(docs, pa.int64(), mask=known == 0), base + np.cumsum(counts) - counts, counts, _crcs(r, counts)]
                    yield pa.RecordBatch.from_arrays([cols[0], *(pa.array(x, pa.int64()) for x in cols[1:])], names=["id", "start", "n_tokens", "ids_crc32"])

    # a number of partitions of its own: rows are few and small, and would be put together into one task
    dealt = placed.repartition(max(1, min(manifest.count(), READ_TASKS)))
    return dealt.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, percentile: int = PERCENTILE, shard_ids: int = SHARD_IDS) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, written to shards in the shared folder and read back from them.

    Null text counts as empty: one id, the end. Null ids come first, in no stated order among themselves, and stay
    null; repeated rows are documents of their own. An empty table gives no rows. Other columns are ignored.
    The shards go when they have been read; write() leaves them in a folder of one's own.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    manifest = write(docs, path, folder, id_col, text_col, end, percentile, shard_ids)
    out = stored(read(manifest, id_col), "token-documents")
    free(manifest)
    remove(docs.sparkSession, folder)
    return out
