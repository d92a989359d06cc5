"""Chained signs against a plain fold; a changed, lost or moved row is found."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marlstone.errors import SpecError
from marlstone.operators import signing

FIELDS = ["name", "n"]


def plain(rows, salt="s"):
    out, last = {}, {}
    for key, at, name, n in sorted(rows, key=lambda r: r[1]):
        m = salt + "".join("-" if v is None else f"{len(str(v))}:{v}" for v in (name, n))
        last[key] = hashlib.sha256((last.get(key, "") + m).encode()).hexdigest()
        out[key, at] = last[key]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    keys = ["a", "b", "", None, "null"]
    many = [("hot", i, rng.choice(["x", "", None, "1:x"]), i % 7 or None) for i in range(3000)]  # more than an Arrow batch of the test
    return many + [(rng.choice(keys), 10_000 + i, rng.choice(["x", "", None]), rng.choice([1, 12, None])) for i in range(200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, at long, name string, n int").repartition(7)


def test_against_a_fold(spark, rows, monkeypatch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = signing.chained(frame(spark, rows), "key", ["at"], FIELDS, "s").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.key, r.at): r.sign for r in got} == plain(rows) and len(got) == len(rows)
    assert signing.chained(frame(spark, rows).limit(0), "key", ["at"], FIELDS, "s").collect() == []
    with pytest.raises(SpecError):
        signing.chained(frame(spark, rows), "key", ["at"], FIELDS, "s", "name")


def test_messages_tell_rows_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("-", "ab"), ("1:a", "b")], "x string, y string")
    assert df.select(signing.message("", ["x", "y"])).distinct().count() == 6


def test_a_changed_row_breaks_all_that_follow(spark, rows):
    signed = signing.chained(frame(spark, rows), "key", ["at"], FIELDS, "s")
    hit = (F.col("key") == "hot") & (F.col("at") == 1234)
    changed = signed.withColumn("name", F.when(hit, "forged").otherwise(F.col("name")))
    got = signing.verified(changed, "key", ["at"], FIELDS, "s").collect()
    assert [r.at for r in got if not r.link] == [1234]
    assert sorted(r.at for r in got if not r.chain) == list(range(1234, 3000))
    resigned = changed.withColumn("sign", F.when(hit, F.sha2(F.lit("x"), 256)).otherwise(F.col("sign")))
    assert sorted(r.at for r in signing.verified(resigned, "key", ["at"], FIELDS, "s").where("not link").collect()) == [1234, 1235]
    lost = signing.verified(signed.where(~hit), "key", ["at"], FIELDS, "s").collect()
    assert [r.at for r in lost if not r.link] == [1235] and sorted(r.at for r in lost if not r.chain) == list(range(1235, 3000))
    assert signing.verified(signed, "key", ["at"], FIELDS, "s").where("not link or not chain").count() == 0
    assert signing.verified(signed, "key", ["at"], FIELDS, "other salt").where("link or chain").count() == 0
