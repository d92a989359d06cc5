"""Markdown documents: lines with sections, quoted names, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, sha256, line, text, section): lines from 1 with the heading that they stand under.

    A document is read by one task; documents are files that people read.
    """
    raw = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    return number_lines(raw, "path", "value")


def number_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("path"), F.sha2(text_col, 256).alias("sha256"), F.posexplode(F.split(text_col, r"\r?\n")).alias("at", "text"))
    heading = F.when(F.col("text").rlike(r"^#{1,6}\s"), F.trim(F.regexp_replace("text", r"^#{1,6}\s+", "")))
    section = F.last(heading, ignorenulls=True).over(Window.partitionBy("path").orderBy("at"))
    return rows.select("path", "sha256", (F.col("at") + 1).alias("line"), "text", section.alias("section"))


def quoted_names(numbered: DataFrame) -> DataFrame:
    """(path, line, section, name) of `names` in backticks."""
    names = F.regexp_extract_all("text", F.lit("`([^`]+)`"), 1)
    return numbered.select("path", "line", "section", F.explode(names).alias("name"))


def table_cells(numbered: DataFrame) -> DataFrame:
    """(path, line, section, cells) of rows of Markdown tables, rulers left out."""
    body = F.regexp_replace(F.trim("text"), r"^\||\|$", "")
    cells = F.transform(F.split(body, r"(?<!\\)\|"), lambda c: F.trim(c))
    return numbered.where(F.col("text").rlike(r"^\s*\|.*\|\s*$") & ~F.col("text").rlike(r"^\s*\|[\s:|-]+\|\s*$")).select("path", "line", "section", cells.alias("cells"))
