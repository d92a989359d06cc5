"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns: every operator has a defined result."""

import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone.llm import bpe, exactdup, html, license, linededup, neardup, packing, pii, quality, qualityrules
from marlstone.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, doc string, key string, h string, n long, node long, comp string, label string"
LONG = "word " * 30_000
ROWS = [
    (1, "the same line of text that is long enough to count\nand another one " + "x" * 40, "en", "a"),
    (2, "the same line of text that is long enough to count\nand another one " + "x" * 40, "en", "a"),
    (3, None, None, None),
    (None, "no id here but a text", "en", "b"),
    (4, "", "en", None),
    (5, " \n\t ", "en", "a"),
    (6, LONG, "en", "a"),
    (7, "Licensed under the MIT License.", None, "a"),
    (7, "Licensed under the MIT License.", None, "a"),
    (8, "x" * 100_000, "en", "a"),
    (9, "\U0001f600 é ÀÉ 日本 ​", "en", "a"),
]


def full(rows):
    return [(*r, len(r[1] or ""), 0, "d", "k", "h", 0, 0, "c", "l") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(full(ROWS), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "bpe": lambda d: bpe.round_trip(d, tokenizer("word_bpe_49k.json")),
    "pii": pii.find,
    "near": neardup.near_duplicates,
    "rules": qualityrules.quality_rules,
    "license": license.scan,
    "line": linededup.line_dedup,
    "exact": exactdup.exact_dedup,
    "html": lambda d: html.extract(d.withColumn("url", F.lit("u")), "doc_id", "text"),
    "quality": lambda d: quality.classify(d, labels(d.sparkSession, [(1, 1, 0), (6, 0, 0), (None, 1, 0), (2, None, 0), (6, 0, 0)])),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(docs, none, name):
    got = OPERATORS[name](docs).collect()
    assert len(got) == len(ROWS)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert OPERATORS[name](none).collect() == []


def test_exact(docs):
    got = {(r.doc_id, r.text_sha256): r for r in exactdup.exact_dedup(docs).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[3, empty].keep_id, got[3, empty].group_size, got[3, empty].kept) == (3, 2, True)
    assert (got[4, empty].keep_id, got[4, empty].kept) == (3, False)
    blank = hashlib.sha256(b" ").hexdigest()
    assert got[5, blank].group_size == 1
    rows = [r for r in exactdup.exact_dedup(docs).collect() if r.doc_id == 7]
    assert [(r.group_size, r.kept) for r in rows] == [(2, True), (2, True)]


def test_near(docs):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert got[2].component_id == 1 and not got[2].kept
    assert got[3].n_shingles == 0 and got[3].component_id == 3 and got[4].component_id == 4
    assert got[6].n_shingles == 1 and got[7].n_shingles == 1 and got[7].kept
    assert got[None].kept


def test_rules(docs):
    got = {r.doc_id: r for r in qualityrules.quality_rules(docs).collect()}
    assert got[3].n_words == 0 and got[3].base_failed and not got[3].kept
    assert got[6].n_words == 30_000 and got[6].n_repeat_words == 30_000 and got[6].base_failed


def test_license(docs):
    got = {r.doc_id: r for r in license.scan(docs).collect()}
    assert (got[7].n_base, got[7].first_word, got[7].base_labels, got[7].labels) == (1, 3, "mit", "mit,mit-notice")
    assert got[3].n_words == 0 and got[3].labels == "" and got[3].first_word is None


def test_lines(docs):
    got = {r.doc_id: r for r in linededup.line_dedup(docs).collect()}
    assert got[1].n_exact == 0 and got[2].n_exact == 2 and got[2].text == ""
    assert got[3].text == "" and got[3].n_lines == 1
    kept = {r.doc_id for r in linededup.dedup_documents(docs).collect()}
    assert 2 not in kept and {1, 3, 4, 5} <= kept
    assert linededup.dedup_documents(docs).columns == docs.columns


def test_pack(docs, none):
    path = tokenizer("byte_bpe_50k.json")
    got = packing.pack(docs, path, ids=True).collect()
    assert [(r.length, r.ids) for r in got if r.doc_id == 3] == [(1, [0])]
    assert len({r.sequence_id for r in got}) == len(got)
    assert packing.pack(none, path).collect() == []
    assert packing.lengths(2048 + 5) == [1024, 1024, 4, 1] and packing.lengths(1) == [1]


def test_quality_without_labels(docs):
    got = quality.classify(docs, labels(docs.sparkSession)).collect()
    assert {r.score for r in got if r.doc_id == 1} == {0.5}
    assert {r.score for r in got if r.doc_id == 3} == {0.0}
    assert {r.held_out for r in got if r.doc_id is None} == {True}


STAGES = {
    "rules": qualityrules.good_documents,
    "line": linededup.dedup_documents,
    "near": neardup.first_of_each,
    "pii": pii.redact,
}
#: Names that operators use within.
CLASHING = ["_key", "_held", "gone", "n_exact", "n_near", "id_", "doc_", "_doc", "_rest", "_bit", "_block", "_bitmap", "_flag", "host", "doc2", "near", "first", "line", "at", "set1", "kept", "component_id"]


@pytest.mark.parametrize("name", STAGES)
def test_stages_of_the_pipeline(docs, none, name):
    for c in CLASHING:
        docs, none = docs.withColumn(c, F.lit("mine")), none.withColumn(c, F.lit("mine"))
    got = STAGES[name](docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} <= {r[0] for r in ROWS} and all(r[c] == "mine" for r in rows for c in CLASHING)
    assert STAGES[name](none).collect() == [] and STAGES[name](none).columns == none.columns


def test_near_link_through_a_row_without_id(spark):
    """1 links with the row without an id, and that with 2, while 1 and 2 don't link: one component."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:50]), " ".join(words[3:53]), " ".join(words[6:56])]
    made = lambda ids: {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).collect()}
    assert made([1, 9, 2]) == {1: 1, 9: 1, 2: 1}
    assert made([1, None, 2]) == {1: 1, None: 1, 2: 1}
