"""Ranked lexical search: posting lists with blocks of variable size, and search that skips blocks by their maxima.

Documents are dealt to shards. In a shard each term has a posting list of (document, score): what the term adds
to a document's score. A block of postings bounds the scores of all documents from its first to its last by its
largest score. Dynamic programming cuts a list into blocks: it minimises the sum, over all documents, of the bound less
the score (0 for a document without the term), plus a fixed cost for each block. A query's bound for a document is the
sum of the blocks that it lies in; it changes at their ends alone. Documents are scored exactly, the highest bound
first, until all that are left have bounds below the k-th best score: their blocks are skipped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free, stored

TOP = 50
#: Terms of the items that are searched for at once, about; more items go in several rounds over the documents.
ROUND_TERMS = 200_000
#: Documents of a shard, at most.
SHARD_DOCS = 32_768
#: Postings of a block, at most, and what a block costs in units of score.
BLOCK_MOST, BLOCK_COST = 64, 1 << 32
#: Documents that are scored before the first look at the bounds; their number doubles from look to look.
STEP_DOCS = 128

#: A to Z in lower case, letters, digits and bytes of other characters as they are, all else a space.
_FOLD = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in bytes(range(256)).lower())


def terms(text: bytes | None) -> list[bytes]:
    """The runs of ASCII letters and digits and of characters beyond ASCII of a UTF-8 text, with A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


def blocks(docs: np.ndarray, scores: np.ndarray, offsets: np.ndarray, most: int = BLOCK_MOST, cost: int = BLOCK_COST) -> tuple[np.ndarray, np.ndarray]:
    """(block ends, first block of each list) of the lists that lie in docs and scores, list i from offsets[i] to offsets[i + 1].

    A block end is the place after its last posting. The cut of each list has the least sum of width * maximum
    and cost a block, among all cuts into blocks of at most `most` postings; the width is that of the range of documents.
    All lists are solved at once, a posting of each at a time.
    """
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    step = np.zeros(len(docs), np.int32)  # length of the best last block of the prefix that ends here
    alive = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # lists with more than i postings
    n = int(alive[0]) if longest else 0
    top = np.zeros((n, most), np.int64)  # maximum of the last 1, 2, ... postings
    begin = np.zeros((n, most), np.int64)  # the first document of these
    past = np.full((n, most), np.iinfo(np.int64).max // 4, np.int64)  # least cost of the prefix before them
    past[:, 0] = 0
    starts = offsets[:-1][order]
    for i in range(longest):
        n = int(alive[i])
        at = starts[:n] + i
        score, doc = scores[at].astype(np.int64)[:, None], docs[at].astype(np.int64)[:, None]
        top = np.concatenate((score, np.maximum(top[:n, :-1], score)), axis=1)
        begin = np.concatenate((doc, begin[:n, :-1]), axis=1)
        total = past[:n] + top * (doc + 1 - begin)
        best = total.argmin(axis=1)
        step[at] = best + 1
        past = np.concatenate((total[np.arange(n), best][:, None] + cost, past[:n, :-1]), axis=1)
    last, is_end, first = offsets[1:][sizes > 0] - 1, np.zeros(len(docs), bool), offsets[:-1][sizes > 0]
    while len(last):
        is_end[last] = True
        last = last - step[last]
        on = last >= first
        last, first = last[on], first[on]
    ends = np.flatnonzero(is_end) + 1
    return ends, np.searchsorted(ends, offsets, side="right")


@dataclass
class Shard:
    """Posting lists of a bounded number of documents; term numbers are those of the round's vocabulary."""

    terms: np.ndarray  # ascending
    offsets: np.ndarray  # of each term's list
    docs: np.ndarray
    scores: np.ndarray
    first: np.ndarray  # first block of each term
    begins: np.ndarray  # first and last document and largest score of each block
    lasts: np.ndarray
    maxima: np.ndarray
    n_docs: int

    @staticmethod
    def build(n_docs: int, doc: np.ndarray, term: np.ndarray, score: np.ndarray, most: int = BLOCK_MOST, cost: int = BLOCK_COST) -> Shard:
        order = np.lexsort((doc, term))
        doc, term, score = doc[order], term[order], score[order]
        known, begin = np.unique(term, return_index=True)
        offsets = np.append(begin, len(term))
        ends, first = blocks(doc, score, offsets, most, cost)
        starts = np.append(0, ends)[:-1]
        return Shard(known, offsets, doc, score, first, doc[starts], doc[ends - 1], np.maximum.reduceat(score, starts) if len(ends) else score, n_docs)

    def search(self, query: np.ndarray, threshold: int = 0, k: int = TOP) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents scored): all that may be among the k best, given that k elsewhere reach threshold."""
        at = np.searchsorted(self.terms, query)
        at[at == len(self.terms)] = 0
        lists = at[self.terms[at] == query].tolist() if len(self.terms) else []
        none = np.empty(0, np.int64)
        if not lists:
            return none, none, 0
        own = np.concatenate([np.arange(self.first[t], self.first[t + 1]) for t in lists])
        change = np.bincount(self.begins[own], self.maxima[own], self.n_docs + 1) - np.bincount(self.lasts[own] + 1, self.maxima[own], self.n_docs + 1)
        bound = np.cumsum(change[:-1])  # whole numbers below 2^53, exact
        threshold = max(threshold, 1)
        left = np.flatnonzero(bound >= threshold)
        left = left[np.argsort(-bound[left], kind="stable")]
        found, values, scored, step = [], none, 0, STEP_DOCS
        while len(left) and bound[left[0]] >= threshold:
            left = left[: np.searchsorted(-bound[left], -threshold, side="right")]
            chosen, left = np.sort(left[:step]), left[step:]
            got = self._score(chosen, lists)
            scored, step = scored + len(chosen), 2 * step
            on = got >= threshold
            found.append((chosen[on], got[on]))
            values = np.concatenate((values, got[on]))
            if len(values) >= k:
                values = np.partition(values, len(values) - k)[-k:]
                threshold = max(threshold, int(values.min()))
        docs, got = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)
        on = got >= threshold
        return docs[on], got[on], scored

    def _score(self, chosen: np.ndarray, lists: list[int]) -> np.ndarray:
        """Exact scores of chosen documents, ascending."""
        out = np.zeros(len(chosen), np.int64)
        for t in lists:
            docs = self.docs[self.offsets[t] : self.offsets[t + 1]]
            at = np.searchsorted(docs, chosen)
            at[at == len(docs)] = 0
            hit = np.flatnonzero(docs[at] == chosen)
            out[hit] += self.scores[self.offsets[t] + at[hit]]
        return out


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term binary): the distinct terms of each item; rows with one id make one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                ids, out = [], []
                for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = set(terms(text))
                    ids += [item] * len(own)
                    out += own
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["item", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "item long, term binary").distinct()


def _counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, counts): the number of terms of each document with any, and which terms of the vocabulary it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                ids, sizes, ends, own, often = [], [], [0], [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    all_ = terms(text)
                    if not all_:
                        continue
                    counts = Counter(all_)
                    for t in counts.keys() & vocabulary.keys():
                        own.append(vocabulary[t])
                        often.append(counts[t])
                    ids.append(doc)
                    sizes.append(len(all_))
                    ends.append(len(own))
                at = pa.array(ends, pa.int32())
                cols = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(own, pa.int32())), pa.ListArray.from_arrays(at, pa.array(often, pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "n", "terms", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc long, n long, terms array<int>, counts array<long>")


def _best(doc: list, score: np.ndarray, k: int) -> list[tuple[int, int | None]]:
    """The k best of (score, document): equal scores by ascending id, null ids last."""
    return sorted(zip(score.tolist(), doc, strict=True), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]


def _searched(counted: DataFrame, queries: list[tuple[int | None, np.ndarray]], weights: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    """(item, doc, score): of each task, the k best documents for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in queries]

        def search(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts).combine_chunks()
            names, n = rows.column("doc").to_pylist(), rows.column("n").to_numpy()
            lists = rows.column("terms").combine_chunks()
            term, tf = lists.flatten().to_numpy(), rows.column("counts").combine_chunks().flatten().to_numpy()
            # documents of a length stand together: their scores are alike, which makes good blocks
            order = np.argsort(n, kind="stable")
            number = np.empty(len(n), np.int64)
            number[order] = np.arange(len(n))
            each = np.diff(lists.offsets.to_numpy())
            m = 50 + 50 * n * total // length
            score = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, each)))
            shard = Shard.build(len(n), np.repeat(number, each), term, score)
            names = [names[i] for i in order]
            for q, (_, own) in enumerate(queries):
                held = best[q]
                docs, got, _ = shard.search(own, held[-1][0] if len(held) == k else 0, k)
                if len(docs):
                    best[q] = _best([d for _, d in held] + [names[i] for i in docs], np.append(np.array([s for s, _ in held], np.int64), got), k)

        parts, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, SHARD_DOCS - n)
                parts.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == SHARD_DOCS:
                    search(parts)
                    parts, n = [], 0
        if parts:
            search(parts)
        flat = [(queries[q][0], doc, score) for q, x in enumerate(best) for score, doc in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], names=["item", "doc", "score"])

    return counted.mapInArrow(run, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = TOP, round_terms: int = ROUND_TERMS) -> DataFrame:
    """(item, rank, document, score): the k highest-scoring documents of each item, all with a score above 0 if fewer.

    Rows of one item id make one item of all their terms; a null id is an id. Documents and items without a term, or
    with a null text, give no rows and count for nothing. Repeated documents are ranked each; equal scores go by
    ascending id, null ids last. Empty tables give no rows. Other columns are ignored.

    Items go in rounds of about round_terms terms: what the tasks are sent, and the driver holds, is a round's terms.
    """
    spark = docs.sparkSession
    wanted = stored(_item_terms(items, item_col, item_text), "search-items")
    rounds = max(1, -(-wanted.count() // round_terms))
    found = []
    for i in range(rounds):
        mine = wanted.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == i).collect()
        vocabulary = {t: j for j, t in enumerate(sorted({bytes(r.term) for r in mine}))}
        counted = stored(_counted(docs, id_col, text_col, vocabulary), "search-counts")
        total, length = counted.agg(F.count("*"), F.sum("n")).first()
        if not total or not mine:
            free(counted)
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the round
            df[r.term] = r["count"]
        weight = np.array([floor(1000 * log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        by: dict[int | None, list[int]] = {}
        for r in mine:
            by.setdefault(r.item, []).append(vocabulary[bytes(r.term)])
        queries = [(item, np.array(sorted(x), np.int64)) for item, x in by.items()]
        # each task sends k rows an item: so many small files go together, up to a shard
        tasks = max(-(-total // SHARD_DOCS), spark.sparkContext.defaultParallelism)
        found.append(stored(_searched(counted.coalesce(tasks), queries, weight, total, length, k), "search-found"))
        free(counted)
    free(wanted)
    columns = f"`{item_col}` long, rank int, `{id_col}` long, score long"
    if not found:
        return spark.createDataFrame([], columns)
    rows = found[0]
    for x in found[1:]:
        rows = rows.unionByName(x)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
