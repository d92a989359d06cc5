"""Selectors of columns, panels, roles of reports and manifests."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.catalog import Catalog, Entity, Relation
from marlstone.errors import SpecError
from marlstone.functions import layout, selectors
from marlstone.plans.compile import compile_report
from marlstone.sources import sinks


def decoded(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", selectors.decoded(F.col("t")).alias("d")).orderBy("i").collect()
    return [None if r.d is None else (r.d.kind, r.d.literal, r.d.target, r.d.key) for r in rows]


def test_decoding(spark):
    key = lambda *k, target=None: ("selector", None, list(target) if target else None, list(k))
    bad = ("invalid", None, None, None)
    cases = {
        "#ABC": key("ABC"), "##ABC": ("literal", "#ABC", None, None), "###ABC": key("#ABC"), "####ABC": ("literal", "##ABC", None, None), "ABC": ("literal", "ABC", None, None), "": ("literal", "", None, None), None: None,
        "#a|b c|d": key("a", "b c", "d"), "#[t]k": key("k", target=["t"]), "#[t|u]k|l": key("k", "l", target=["t", "u"]), "#@Spl": key("@Spl"), "#[@Spl]admin": key("admin", target=["@Spl"]), r"#\@x": key("@x"),
        r"#a\|b|c\\": key("a|b", "c\\"), r"#\[x\]\#": key("[x]#"), r"#[a\]b|c]d": key("d", target=["a]b", "c"]), "###[t]k": bad, "#[t]": bad, "#[]k": bad, "#[t": bad, "#a]": bad, r"#a\x": bad, "#a\\": bad, "#": bad, "###": key("#"), "##": ("literal", "#", None, None),
        "#a||b": key("a", "", "b"), "#نام|é": key("نام", "é"),
    }
    assert dict(zip(cases, decoded(spark, list(cases)), strict=True)) == cases


def test_round_trip(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("ab|[]\\#@ é") for _ in range(rng.randrange(1, 6)))
    rows = [(i, [word() for _ in range(rng.randrange(1, 4))], [word() for _ in range(rng.randrange(3))]) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k array<string>, t array<string>")
    got = df.withColumn("d", selectors.decoded(selectors.encoded(F.col("k"), F.col("t")))).orderBy("i").collect()
    assert [(r.d.kind, r.d.key, r.d.target or []) for r in got] == [("selector", k, t) for _, k, t in rows]
    none = spark.createDataFrame([(None, None), ([], ["t"]), ([""], None)], "k array<string>, t array<string>")
    assert [r[0] for r in none.select(selectors.encoded(F.col("k"))).collect()] == [None, None, None]


def test_panels(spark):
    cases = [(4, 2, True, 94), (4, 2, False, 66), (0, 3, True, 46), (0, 3, False, 34), (1, 1, False, 42), (5, 2, False, 90), (3, 0, True, None), (None, 2, True, None), (3, 2, None, None), (-1, 2, False, 34)]
    df = spark.createDataFrame(cases, "n int, c int, s boolean, want long")
    assert df.where(~layout.panel_height(F.col("n"), F.col("c"), F.col("s")).eqNullSafe(F.col("want"))).count() == 0


@pytest.fixture(scope="module")
def catalog(spark):
    data = {"thing": spark.createDataFrame([(1, 10, "a"), (2, None, "b")], "id int, owner_id int, t string"), "owner": spark.createDataFrame([(10, "o")], "oid int, name string")}
    relations = [Relation("owner", "thing", "owner_id", "owner", "oid"), Relation("things", "owner", "oid", "thing", "owner_id", many=True)]
    return Catalog(lambda n: data[n], [Entity("thing", "id"), Entity("owner", "oid")], relations)


def test_roles(catalog):
    report = {"entity": "thing", "columns": [{"field": "id", "alias": "id"}], "forum": {"titleField": "t", "ownerIdField": {"items": ["owner", "name"]}, "time": "id"}}
    df = compile_report(catalog, report)
    assert df.columns == ["id", "forum:titleField", "forum:ownerIdField"] and sorted(map(tuple, df.collect())) == [(1, "a", "o"), (2, "b", None)]
    for wrong in ({"forum": {"subject": "t"}}, {"calendar": ["t"]}, {"calendar": {"name": "gone"}}, {"calendar": {"name": {"items": ["owner", "things", "t"]}}}, {"calendar": {"name": "t"}, "sqlGrouping": ["id"]}):
        with pytest.raises(SpecError):
            compile_report(catalog, {**{k: v for k, v in report.items() if k != "forum"}, **wrong})


def test_a_manifest_states_its_own_size(spark, tmp_path):
    assert sinks.settled_size(95, lambda n: f"{n:>5}") == 100 and sinks.settled_size(9, str) == 11
    with pytest.raises(SpecError):
        sinks.settled_size(0, lambda n: "x" * (1 + n % 2))
    path = str(tmp_path / "p")
    for name, n in (("a", 100), ("b", 5)):
        spark.range(n).repartition(2).write.parquet(f"{path}/{name}")
    made = sinks.write_manifest(spark, path, "1")
    assert made["totalBytes"] == sum(f.stat().st_size for f in (tmp_path / "p").rglob("part-*")) + (tmp_path / "p" / "manifest.json").stat().st_size
    assert sinks.read_manifest(spark, path, "1") == (made, []) and [t["files"] for t in made["tables"]] == [2, 2]
    spark.range(1).write.mode("append").parquet(f"{path}/a")
    spark.range(1).write.parquet(f"{path}/c")
    assert sinks.read_manifest(spark, path, "2")[1] == ["version 1 is not 2", "table c is not in the manifest", "table a has changed"]
