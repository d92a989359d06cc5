"""Writers: stable JSON, Markdown tables of bounded size, indexes by system, packs that replace as a whole."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import SpecError


def stable_json(df: DataFrame) -> DataFrame:
    """(json): one object a row, names sorted, NULLs written."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("json"))


def write_ndjson(df: DataFrame, path: str, order: list[str]) -> None:
    """One object a line, sorted within files; large outputs stay many files."""
    df.sortWithinPartitions(*order).select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_index(df: DataFrame, path: str, system_col: str = "system_id") -> None:
    """An index in a folder for each system, so that a reader of one system opens its files only."""
    df.write.mode("overwrite").partitionBy(system_col).parquet(path)


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A Markdown table; a DataFrame of more than most rows is refused, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise SpecError(f"more than {most} rows")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    out = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"


def trimmed(df: DataFrame, group: str, order: list[str], shown: int = 25) -> DataFrame:
    """The first rows of each collection, each with the collection's total: samples say that they are samples."""
    first = df.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= shown).drop("_rn")
    return first.join(df.groupBy(group).agg(F.count("*").alias("total")), group)


def write_pack(tables: dict[str, DataFrame], path: str, gates: DataFrame) -> None:
    """Write all tables, or none if a gate failed; tables of an earlier pack that are no longer wanted are deleted."""
    failed = [r.gate for r in gates.where(~F.col("passed")).select("gate").limit(100).collect()]
    if failed:
        raise SpecError(f"nothing is written, gates failed: {', '.join(failed)}")
    spark = gates.sparkSession
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staging = jvm.org.apache.hadoop.fs.Path(f"{path}.staging")
    fs.delete(staging, True)
    for name, df in tables.items():
        df.write.parquet(f"{path}.staging/{name}")
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    fs.delete(old, True)
    if fs.exists(root):
        fs.rename(root, old)
    fs.rename(staging, root)
    fs.delete(old, True)


#: Rounds in which a manifest's own size settles.
ROUNDS = 6


def settled_size(others: int, render: Callable[[int], str]) -> int:
    """The size of a pack whose manifest states it: others' bytes and the manifest's, which depend on what it states."""
    total = others
    for _ in range(ROUNDS):
        now = others + len(render(total).encode())
        if now == total:
            return total
        total = now
    raise SpecError("the manifest's size doesn't settle")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(table, files, bytes, newest file's name) of each table of a pack. Listed by Spark; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    table = F.element_at(F.split("path", "/"), -2)
    return listed.groupBy(table.alias("table")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max(F.element_at(F.split("path", "/"), -1)).alias("last"))


def write_manifest(spark: SparkSession, path: str, version: str) -> dict:
    """Writes path/manifest.json: each table's files and bytes, and the size of the whole pack with the manifest itself."""
    tables = [r.asDict() for r in _files(spark, path).orderBy("table").collect()]  # a row for each table
    render = lambda n: json.dumps({"version": version, "tables": tables, "totalBytes": n}, sort_keys=True)
    total = settled_size(sum(t["bytes"] for t in tables), render)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest.json")
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(render(total).encode()))
    out.close()
    return json.loads(render(total))


def read_manifest(spark: SparkSession, path: str, version: str) -> tuple[dict, list[str]]:
    """(manifest, findings): what of the pack isn't as its manifest says. A pack without findings may be read."""
    text = "".join(r.value for r in spark.read.text(f"{path}/manifest.json", wholetext=True).collect())
    manifest = json.loads(text)
    out = [] if manifest["version"] == version else [f"version {manifest['version']} is not {version}"]
    told, there = {t["table"]: t for t in manifest["tables"]}, {r.table: r.asDict() for r in _files(spark, path).collect()}
    out += [f"table {t} is {'missing' if t in told else 'not in the manifest'}" for t in sorted(told.keys() ^ there.keys())]
    out += [f"table {t} has changed" for t in sorted(told.keys() & there.keys()) if told[t] != there[t]]
    if manifest["totalBytes"] != sum(t["bytes"] for t in manifest["tables"]) + len(text.encode()):
        out.append("the manifest states another size than its own")
    return manifest, out
