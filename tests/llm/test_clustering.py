"""Screened k-means against the same in plain Python, and the bounds against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from marlstone.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, cluster string, q string"


def rows_of(pairs):
    return [(i, v, 0, 7, "x", "c", "q") for i, v in pairs]


def brute(pairs, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in pairs if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in kept)
    cs = [q for _, q in start[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda q: min((dist(q, c), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [nearest(q)[1] for _, q in kept]
        for j in range(len(cs)):
            mine = [q for (_, q), c in zip(kept, of, strict=True) if c == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, *reversed(nearest(q))) for i, q in kept]
    inertia = {}
    for _, j, d in out:
        inertia[j] = inertia.get(j, 0) + d
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for i, j, d in out)


def got(spark, pairs):
    df = clustering.cluster(spark.createDataFrame(rows_of(pairs), SCHEMA))
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    pairs = [(i, [rng.gauss(i % 5, 0.3 + i % 3) for _ in range(64)]) for i in range(150)]
    pairs += [(200 + i, pairs[3][1]) for i in range(60)]  # one common vector
    pairs += [(3, pairs[3][1]), (3, pairs[3][1]), (None, pairs[9][1])]  # repeated rows, no id
    pairs += [(301, None), (302, []), (303, [0.5] * 63), (304, [0.5] * 63 + [None]), (305, [0.5] * 63 + [float("nan")]), (306, [0.5] * 63 + [float("-inf")]), (307, [0.0] * 64), (308, [-0.0004] * 64), (309, [100_000.0] * 64)]
    assert got(spark, pairs) == brute(pairs)


def test_few_and_none(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == []
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert got(spark, few) == brute(few)
    same = [(i, [0.25] * 64) for i in range(20)]  # all centroids are equal: the smallest number has all
    assert {r[1] for r in got(spark, same)} == {0} and got(spark, same) == brute(same)


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="131072 or more"):
        got(spark, [(1, [0.0] * 63 + [1e30])])


@pytest.mark.parametrize("scale", [1, 1000, 10_000_000])
def test_bounds_hold_and_screen(scale):
    rng = np.random.default_rng(scale)
    centres = rng.normal(size=(16, 8)).repeat(8, axis=1)
    q = np.floor((centres[rng.integers(16, size=3000)] + 0.3 * rng.normal(size=(3000, 64))) * scale).astype(np.int64)
    cs = np.floor(centres * scale).astype(np.int64)
    blocks = clustering.compress(q, 8).astype(np.float32)
    all_ = ((q[:, None, :] - cs[None]) ** 2).sum(axis=2)
    low = clustering.lower_bounds(blocks, cs, 8)
    assert (low <= all_).all()
    cluster, best, took = clustering.assign(q, blocks, cs)
    assert (cluster == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
    assert took < (3000 * 16 if scale == 1 else 3000 * 4)  # mostly screened


def test_segments_must_divide(spark):
    with pytest.raises(ValueError):
        clustering.cluster(spark.createDataFrame(rows_of([]), SCHEMA), segments=7)


