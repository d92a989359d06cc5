"""k-means over integer vectors, exact, with block-norm screening.

A vector is cut into segments. Each segment is compressed to two numbers: its mean, and the norm of what is left of
it beside the mean. For a vector x and a centroid c, Cauchy-Schwarz gives for each segment of m components

    |x - c|^2  >=  m (mean x - mean c)^2 + (norm x - norm c)^2,

so the sum over the segments bounds the distance from below. The compressed vectors are computed once, in single
precision with the rounding taken off the bound; the centroids' once a round. A vector's exact integer distance is
computed for the centroid with the lowest bound, and then for those alone whose bound isn't above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, stored

CENTROIDS = 8
DIMENSIONS = 64
ROUNDS = 10
SEGMENTS = 8
SCALE = 1024
#: Components at or beyond this size are an error: the squared distance of two vectors would not fit 64 bits.
LIMIT = 1 << 27
#: Rows that are screened at once.
SLICE = 4096
#: Relative rounding of a single-precision number, doubled; and a margin for the sums in double precision.
SINGLE, MARGIN = 2.0**-23, 1e-12


def integers(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id long, q array<long>): floor(SCALE * x) of the vectors with exactly dims components, none null or non-finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") == dims) & finite)
    scaled = F.transform("x", lambda v: F.floor(v * SCALE))
    too_large = F.exists("x", lambda v: F.abs(v) * SCALE >= LIMIT)
    return rows.select("id", F.when(too_large, F.raise_error(F.lit(f"a component is {LIMIT // SCALE} or more in size"))).otherwise(scaled).alias("q"))


def compress(q: np.ndarray, segments: int) -> np.ndarray:
    """Segment means, then norms of the rest: n x 2 segments, in double precision."""
    n, d = q.shape
    parts = q.astype(np.float64).reshape(n, segments, d // segments)
    means = parts.mean(axis=2)
    return np.concatenate((means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))), axis=1)


def lower_bounds(blocks: np.ndarray, centroids: np.ndarray, segments: int) -> np.ndarray:
    """n x k bounds that no squared distance is below; blocks are compressed vectors in single precision."""
    x = blocks.astype(np.float64)
    slack = np.abs(x) * SINGLE
    weight = np.repeat((centroids.shape[1] // segments, 1.0), segments)
    low = np.empty((len(x), len(centroids)))
    for j, c in enumerate(compress(centroids, segments)):
        gap = np.abs(x - c)
        gap -= slack + np.abs(c) * MARGIN
        np.maximum(gap, 0, out=gap)
        low[:, j] = (gap * gap) @ weight
    return low * (1 - MARGIN)


def _distance(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = q - c
    return (gap * gap).sum(axis=1)


def assign(q: np.ndarray, blocks: np.ndarray, centroids: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of each row; how many distances it took."""
    low = lower_bounds(blocks, centroids, segments)
    first = low.argmin(axis=1)
    best, cluster, took = _distance(q, centroids[first]), first.copy(), len(q)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero((low[:, j] <= best) & (first != j))
        took += len(rows)
        d = _distance(q[rows], c)
        nearer = (d < best[rows]) | ((d == best[rows]) & (j < cluster[rows]))
        best[rows[nearer]], cluster[rows[nearer]] = d[nearer], j
    return cluster, best, took


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def _slices(batches: Iterator[pa.RecordBatch], dims: int, segments: int):
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            yield part.column(0), _matrix(part.column(1), dims, np.int64), _matrix(part.column(2), 2 * segments, np.float32)


def compressed(rows: DataFrame, dims: int, segments: int) -> DataFrame:
    """(id, q, blocks array<float>): the vectors with their compressed form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                blocks = compress(_matrix(part.column(1), dims, np.int64), segments).astype(np.float32)
                ends = np.arange(len(blocks) + 1, dtype=np.int32) * (2 * segments)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(ends, blocks.ravel())], names=["id", "q", "blocks"])

    return rows.mapInArrow(run, "id long, q array<long>, blocks array<float>")


def _start(rows: DataFrame, salt: str, k: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of salt:id; equal ones by id and components. Ids that repeat count as often."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(digest.alias("digest"), "q").orderBy("digest", "q").limit(k).collect()
    return np.array([r.q for r in first], np.int64)


def _means(rows: DataFrame, centroids: np.ndarray, segments: int) -> np.ndarray:
    """The next centroids. Each task adds up its own vectors; what is shuffled is a row for each task, centroid and component."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for _, q, blocks in _slices(batches, dims, segments):
            cluster, _, _ = assign(q, blocks, centroids, segments)
            for j in range(k):
                mine = q[cluster == j]
                total[j, :dims] += mine.sum(axis=0)
                total[j, dims] += len(mine)
        at = np.flatnonzero(np.repeat(total[:, dims] > 0, dims + 1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], names=["cell", "total"])

    sums = np.zeros(k * (dims + 1), np.int64)
    for r in rows.mapInArrow(run, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).collect():  # k * (dims + 1) rows
        sums[r.cell] = r.total
    sums = sums.reshape(k, dims + 1)
    out = centroids.copy()
    full = sums[:, dims] > 0
    out[full] = sums[full, :dims] // sums[full, dims:]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CENTROIDS, dims: int = DIMENSIONS, rounds: int = ROUNDS, segments: int = SEGMENTS, salt: str = "3") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256): a row for each vector that is kept.

    Vectors with another number of components, or with a null or non-finite one, and null vectors are left out; a
    component of 131,072 or more in size is an error, as distances would not fit 64 bits. Repeated rows are vectors of
    their own; a null id is hashed as an empty one. Of fewer than k vectors each is a centroid. A centroid
    without vectors stays where it is. Without any vector there are no rows. Other columns are ignored.
    """
    if dims % segments:
        raise ValueError("segments must divide the dimensions")
    spark = vectors.sparkSession
    rows = stored(compressed(integers(vectors, id_col, vec_col, dims), dims, segments), "cluster-vectors")
    centroids = _start(rows, salt, k)
    if not len(centroids):
        free(rows)
        return spark.createDataFrame([], f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = _means(rows, centroids, segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, q, blocks in _slices(batches, dims, segments):
            number, distance, _ = assign(q, blocks, centroids, segments)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    assigned = stored(rows.mapInArrow(run, "id long, cluster int, distance long"), "cluster-assigned")
    free(rows)
    inertia = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # k rows
    of = [(j, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids) if j in inertia]
    each = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
