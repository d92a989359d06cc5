"""Token files: blocks and shards round trip, documents equal the library's ids."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import tokenfiles
from marlstone.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, id long, part int, piece int, file string, row long, start long"
PATH = tokenizer("byte_bpe_50k.json")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, 1, "f", 1, 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("percentile", [1, 50, 95, 100])
def test_blocks(percentile):
    rng = np.random.default_rng(percentile)
    for n in (1, 2, 7, 1000, 1024):
        for top in (1, 2, 255, 50_257, 1 << 32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
            ids[rng.integers(n)] = top - 1
            data = tokenfiles.encode_block(ids, percentile)
            back, at = tokenfiles.decode_block(b"xx" + data + b"yy", 2)
            assert (back == ids).all() and at == 2 + len(data)


def test_patches_are_chosen():
    ids = np.arange(1024, dtype="<u4") % 16 + 9
    ids[::64] = 50_000
    head = tokenfiles._HEAD.unpack_from(tokenfiles.encode_block(ids))
    assert head == (1024, 4, 16, 9)
    assert len(tokenfiles.encode_block(ids)) == tokenfiles._HEAD.size + 512 + 16 * 6


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def key(r):
    return str(r)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted((tuple(r) for r in tokenfiles.round_trip(docs, PATH).collect()), key=lambda r: r[0])
    assert got == want
    # the same rows however the input is dealt, and from many small shards
    assert sorted(tuple(r) for r in tokenfiles.round_trip(docs.repartition(7), PATH, shard_ids=500).collect()) == want


def test_edges(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "é", "日本", "\n\n", "x" * 50]) for _ in range(60_000))
    rows = [(5, "five"), (1, None), (3, ""), (None, "no id"), (2, long), (-9, "minus"), (1 << 60, " \t "), (4, "<|endoftext|> a")]
    assert sorted((tuple(r) for r in tokenfiles.round_trip(frame(spark, rows), PATH).collect()), key=key) == sorted(expected(rows), key=key)
    assert tokenfiles.round_trip(frame(spark, []), PATH).collect() == []


def test_one_id_with_most_rows(spark):
    rows = [(7, "seven")] * 400 + [(i, "other") for i in range(20)] + [(None, "none")] * 30
    got = sorted(tuple(r) for r in tokenfiles.round_trip(frame(spark, rows).repartition(8), PATH, shard_ids=64).na.fill(-1, ["doc_id"]).collect())
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((-1 if i is None else i, n, c) for i, _, n, c in expected(rows))
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == [r[0] for r in got]
    at = 0
    for r in by_start:
        assert r[1] == at
        at += r[2]


def test_random_access(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = Tokenizer.from_file(PATH)
    ids = [x for r in docs.orderBy("doc_id").collect() for x in [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]]
    manifest = tokenfiles.write(docs, PATH, f"file://{tmp_path}", shard_ids=20_000)
    shards = manifest.orderBy("part", "piece").collect()
    assert len(shards) > 3 and sum(r.n_ids for r in shards) == len(ids)
    at = 0
    for r in shards:
        with tokenfiles.Reader(r.file) as f:
            own = np.array(ids[at : at + r.n_ids], "<u4")
            for start, n in ((0, 1), (1023, 2), (1024, 1024), (5000, 3000), (r.n_ids - 1, 9), (r.n_ids, 4)):
                assert (f.ids(start, n) == own[start : start + n]).all()
            assert f.docs()[2].sum() == r.n_ids
        at += r.n_ids
    assert manifest.agg(F.sum("n_docs")).first()[0] == docs.count()
    (tmp_path / "other").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        tokenfiles.Reader(f"file://{tmp_path}/other")
