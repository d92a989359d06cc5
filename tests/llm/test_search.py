"""Block-skipping search against full scoring, and the blocks against all ways to cut a list."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import search

SCHEMA = "doc_id long, text string, lang string, item long, doc long, term string, n long, score long, rank int"
ITEMS = "item_id long, text string, doc_id long, score long, item long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    held = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(terms(t))
    out = []
    for item, q in own.items():
        scored = []
        for doc, c, n in held:
            m = 100 - 50 + 50 * n * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in q if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "en", 1, 1, "t", 1, 1, 1) for i, t in docs], SCHEMA)
    q = spark.createDataFrame([(i, t, 1, 1, 1) for i, t in items], ITEMS)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.search(d, q, **options).collect()), key=str)


def corpus(rng, n):
    words = [f"w{int(1 / (rng.random() + 0.002))}" for _ in range(4000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(n)]


def test_against_full_scoring(spark):
    rng = random.Random(2)
    docs = corpus(rng, 700)
    docs += [(1000 + i, docs[5][1]) for i in range(80)]  # a large group of copies: equal scores
    docs += [(5, docs[5][1]), (None, docs[5][1]), (2000, None), (2001, ""), (2002, " ?!\n"), (2003, "W1 w1, W2's É日本 é \x7f x" * 3000), (-4, docs[5][1])]
    items = [(i, docs[i * 7][1]) for i in range(30)] + [(40, docs[5][1]), (41, None), (42, "--"), (43, "nowhere"), (44, "É日本"), (None, "w3 w4"), (0, "w1 w1 W9")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, items, k=3, round_terms=40) == brute(docs, items, 3)  # several rounds


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 64)
    rng = random.Random(3)
    docs, items = corpus(rng, 500), [(i, f"w{i} w1 w{2 * i} w300") for i in range(1, 12)]
    assert got(spark, docs, items) == brute(docs, items)


def test_empty(spark):
    assert got(spark, [], [(1, "a")]) == got(spark, [(1, "a")], []) == got(spark, [], []) == []
    assert got(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")])


def test_terms_as_by_the_pattern():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(128, 0x800), rng.randrange(0x800, 0xD800), rng.randrange(0x10000, 0x11000)])) for _ in range(60))
        assert [t.decode() for t in search.terms(text.encode())] == terms(text)


def least_cost(docs, x, most, cost):
    """Least cost of a list by plain dynamic programming."""
    least = [0]
    for i in range(1, len(x) + 1):
        least.append(min(least[j] + (docs[i - 1] - docs[j] + 1) * max(x[j:i]) + cost for j in range(max(0, i - most), i)))
    return least[-1]


@pytest.mark.parametrize("cost", [0, 3, 40, 500])
def test_blocks_have_the_least_cost(cost):
    rng = random.Random(cost)
    lists = [[rng.randrange(1, 30) for _ in range(rng.choice([0, 1, 2, 7, 40]))] for _ in range(25)]
    docs = [sorted(rng.sample(range(100), len(x))) for x in lists]
    offsets = np.append(0, np.cumsum([len(x) for x in lists]))
    ends, first = search.blocks(np.array(sum(docs, []), np.int64), np.array(sum(lists, []), np.int64), offsets, most=6, cost=cost)
    for i, x in enumerate(lists):
        cuts = [int(e) - int(offsets[i]) for e in ends[first[i] : first[i + 1]]]
        assert (cuts[-1:] or [0]) == [len(x)]
        begin, total = 0, 0
        for e in cuts:
            assert 0 < e - begin <= 6
            total += (docs[i][e - 1] - docs[i][begin] + 1) * max(x[begin:e]) + cost
            begin = e
        assert total == least_cost(docs[i], x, 6, cost)


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    n = 20_000
    doc, term = np.nonzero(rng.random((n, 12)) < np.linspace(0.02, 0.5, 12))
    score = rng.integers(1000, 400_000, len(doc)) * np.linspace(4000, 100, 12).astype(int)[term]
    shard = search.Shard.build(n, doc, term, score, cost=1 << 27)
    full = np.zeros(n, np.int64)
    np.add.at(full, doc, score)
    docs, values, scored = shard.search(np.arange(12), 0, 10)
    order = np.lexsort((np.arange(n), -full))[:10]
    assert sorted(zip((-values).tolist(), docs.tolist(), strict=True))[:10] == [(-int(full[d]), int(d)) for d in order]
    assert len(shard.lasts) < 0.8 * len(doc) and scored < 0.1 * n
    assert shard.search(np.arange(12), int(full.max()) + 1, 10)[0].size == 0
    assert shard.search(np.array([12, 99]), 0, 10)[0].size == 0


def test_blocks_are_skipped_on_documents(spark):
    """Of real documents and items a small part is scored, and the k-th best score is right."""
    docs = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    held = [c for c in (Counter(search.terms(t.encode())) for t in docs) if c]
    number = {t: i for i, t in enumerate(sorted({t for c in held for t in c}))}
    doc = np.array([d for d, c in enumerate(held) for _ in c])
    term = np.array([number[t] for c in held for t in c])
    score = np.array([1_000_000 * n // (n + sum(c.values()) // 100 + 1) for c in held for n in c.values()]) * (3000 // (1 + np.bincount(term)[term] // 20) + 1)
    shard, all_scored, full = search.Shard.build(len(held), doc, term, score), 0, np.zeros(len(held), np.int64)
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    for item in items:
        query = np.array(sorted({number[t] for t in search.terms(item.encode()) if t in number}))
        on = np.isin(term, query)
        full[:] = 0
        np.add.at(full, doc[on], score[on])
        _, values, scored = shard.search(query, 0, 10)
        all_scored += scored
        assert sorted(values, reverse=True)[:10] == sorted(full[full > 0], reverse=True)[:10]
    assert all_scored < 0.5 * len(held) * len(items)
