import re

from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import pii
from marlstone.llm.common import stored

from .test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["quality_rules"]
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    kept = {r.doc_id for r in after.collect()}
    assert not any(len(re.findall(r"[^ \t-\r]+", texts[i])) < 50 for i in kept) and 0 < len(kept) < len(texts)
    before, after = seen["near_dedup"]
    want = brute_components({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in want.items() if i == c}
    before, after = seen["personal_data"]
    assert before.count() == after.count()
    assert not any(pii.base_spans(r.text) for r in after.collect())
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0
    before, after = seen["packing"]
    assert {r.doc_id for r in after.select("doc_id").collect()} == {r.doc_id for r in before.collect()}
    assert corpus_pipeline.run(spark, SF).count() == after.count()
