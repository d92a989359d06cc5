"""Quality classifier: a linear-chain CRF labels every line good or bad.

A line's features describe it and its two neighbours; marginals by forward-backward, weighted by the
lines' lengths, make the document's score. Labels of documents train it: each line of a labelled document
carries the document's label. Features come from byte counts over many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .crf import Model, marginals, padded
from .shingles import CHUNK, _chunk

#: Labelled documents of each class that train the model, chosen by hash of the id. Bounds what the driver holds.
TRAIN_DOCS = 1000
THRESHOLD = 0.3
_STEPS = (0.02, 0.1, 0.3)
_RATIOS = 9
#: Features of a line: ratios, their steps, size, bias.
_OWN = _RATIOS * (1 + len(_STEPS)) + 3
N_FEATURES = 3 * _OWN

_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
for _c in "#*$%&<>^~@\\={}[]_":
    _CLASS[ord(_c)] = 4
_CLASS[ord("|")] = 5
_CLASS[ord("!")] = 6
for _c in ".,;:?\"'()-":
    _CLASS[ord(_c)] = 7
_CLASS[128:] = 8


def _parts(texts: list[str]) -> Iterator[list[bytes]]:
    held, total = [], 0
    for t in texts:
        held.append(t.encode("utf-8", "surrogatepass") + b"\n")
        total += len(held[-1])
        if total >= CHUNK:
            yield held
            held, total = [], 0
    if held:
        yield held


def line_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the features [lines, N_FEATURES] of its lines with a word, and the lines' bytes."""
    out = []
    for parts in _parts(texts):
        data = b"".join(parts)
        raw = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero(raw == 10) + 1
        starts = np.concatenate(([0], ends[:-1]))
        kinds = _CLASS[raw]
        counts = np.stack([np.add.reduceat((kinds == k).astype(np.int32), starts) for k in range(1, 9)], 1)
        at, hashes = _chunk(data)
        line_of = np.searchsorted(ends, at, side="right")
        n_words = np.bincount(line_of, minlength=len(ends))
        same = np.zeros(len(at), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
        repeats = np.bincount(line_of, weights=same, minlength=len(ends))
        size = np.maximum(1, counts.sum(1))
        letters = np.maximum(1, counts[:, 0] + counts[:, 1])
        words = np.maximum(1, n_words)
        ratio = np.stack(
            [counts[:, 0] / letters, counts[:, 2] / size, counts[:, 3] / words / 3, counts[:, 4] / words, counts[:, 5] / words / 2, counts[:, 6] / words, counts[:, 7] / size, repeats / words, np.minimum(1, size / words / 20)],
            1,
        )
        ratio = np.minimum(ratio, 1)
        own = np.concatenate([ratio, *(ratio > s for s in _STEPS), np.log1p(n_words)[:, None] / 5, (n_words >= 8)[:, None], np.ones((len(ends), 1))], 1)
        # documents end where their parts do
        doc_ends = np.cumsum([len(p) for p in parts])
        cut = np.searchsorted(ends, doc_ends, side="right")
        begin = 0
        for stop in cut:
            lines = np.flatnonzero(n_words[begin:stop]) + begin
            x = own[lines]
            beside = np.zeros((2, *x.shape))
            if len(x) > 1:
                beside[0, 1:], beside[1, :-1] = x[:-1], x[1:]
            out.append((np.concatenate([x, beside[0], beside[1]], 1), (ends - starts)[lines].astype(float)))
            begin = stop
    return out


def _scores(features: list[tuple[np.ndarray, np.ndarray]], w: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Length-weighted marginal of label good for each document; 0 without a line."""
    out = np.zeros(len(features))
    order = sorted((i for i, f in enumerate(features) if len(f[0])), key=lambda i: len(features[i][0]))
    at = 0
    while at < len(order):
        longest, stop = len(features[order[at]][0]), at
        # chains of like length share a batch
        while stop < len(order) and stop - at < 256 and len(features[order[stop]][0]) <= max(8, 2 * longest):
            stop += 1
        part = order[at:stop]
        emit, lengths = padded([features[i][0] @ w for i in part])
        _, single, _ = marginals(emit, lengths, trans, start)
        for row, i in zip(single, part, strict=True):
            size = features[i][1]
            out[i] = float((row[: len(size), 1] * size).sum() / size.sum())
        at = stop
    return out


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from (fixed by the contract)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def training_ids(labels: DataFrame, bound: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, label): up to bound labelled documents of each class outside the held-out fold, by hash of the id.

    Rows without id or label are left out, and so are ids with conflicting labels.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most").select("doc_id", "label")
    first = lambda y: one.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return first(0).unionByName(first(1))


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, transitions, start scores) from the texts of training_ids(); the driver gets their lines' features.

    Without a labelled document, or with one class alone, a document's score depends on that class's share only.
    """

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = line_features([t or "" for t in f["text"]])
            yield pd.DataFrame({"doc_id": f["doc_id"], "label": f["label"], "x": [a.astype(np.float32).tobytes() for a, _ in x]})

    ids = F.broadcast(training_ids(labels, bound))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id").select("doc_id", "label", "text").mapInPandas(features, "doc_id long, label int, x binary").collect()
    xs, ys = [], []
    for r in sorted(rows, key=lambda r: (r.doc_id, r.label, r.x)):
        x = np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES).astype(float)
        if len(x):
            xs.append(x)
            ys.append(np.full(len(x), r.label))
    model = Model(N_FEATURES, 2)
    if xs:
        share = [max(1, sum(y[0] == k for y in ys)) for k in (0, 1)]
        order = sorted(range(len(xs)), key=lambda i: len(xs[i]))
        batches = []
        for i in range(0, len(order), 64):
            part = order[i : i + 64]
            x, lengths = padded([xs[j] for j in part])
            y, _ = padded([ys[j] for j in part])
            # both classes weigh the same, and a document the same whatever its length
            weight = np.array([len(xs) / 2 / share[ys[j][0]] / len(xs[j]) for j in part])
            batches.append((x, y, lengths, weight))
        model.fit(batches, epochs=25, rate=0.03, decay=0.0005)
    return model.w, model.trans, model.start


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bound: int = TRAIN_DOCS) -> DataFrame:
    """One row for each input row: id, held_out, score, predicted.

    Null or blank text has no line and scores 0. A null id counts as held out. Repeated rows pass through. An
    empty table gives no rows; empty labels leave every score of a text with lines at 0.5. Only the text is an input of a score.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    w, trans, start = train(base, labels, bound)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i in range(0, len(f), 500):
                part = f.iloc[i : i + 500]
                s = _scores(line_features([t or "" for t in part["text"]]), w, trans, start)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "held_out": part["held_out"].to_numpy(), "score": s})

    scored = base.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.select(F.col("doc_id").alias(id_col), "held_out", F.least(F.lit(1.0), "score").alias("score"), (F.col("score") >= threshold).cast("int").alias("predicted"))
