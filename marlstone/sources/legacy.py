"""Legacy packages: a gzipped stream with an embedded XML schema and its rows. Every cell is text; a missing one is NULL."""

from __future__ import annotations

import gzip
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import masked

_XS = "{http://www.w3.org/2001/XMLSchema}"
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def decode_name(name: str) -> str:
    """XML names spell other characters as _xHHHH_."""
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), name)


def carve(content: bytes) -> tuple[str, str]:
    """The schema and the row document inside a package."""
    body = gzip.decompress(content).decode("utf-8", "replace")
    schema = re.search(r"<xs:schema.*?</xs:schema>", body, re.S)
    rows = re.search(r"<diffgr:diffgram.*?</diffgr:diffgram>", body, re.S)
    if not schema or not rows:
        raise ValueError("no schema or no rows in the package")
    return schema[0], rows[0]


def schema_rows(schema: str) -> list[tuple[str, str, str, bool]]:
    """(table, column, xsd type, nullable) of a data set's schema."""
    out = []
    for data_set in ET.fromstring(schema).iter(f"{_XS}element"):
        for table in data_set.findall(f"{_XS}complexType/{_XS}choice/{_XS}element"):
            name = decode_name(table.get("name"))
            for c in table.iter(f"{_XS}element"):
                if c is not table:
                    out.append((name, decode_name(c.get("name")), (c.get("type") or "").split(":")[-1], c.get("minOccurs") == "0"))
    return out


def read_packages(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalog, cells) of package files(path, content).

    catalog: (path, table, column, type, nullable, is_control); control tables start with $. cells: (path, table, row,
    cells map, error), a row for each table row in document order; a bad package is one row with an error.
    """

    def columns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    rows += [(path, *r, r[0].startswith("$")) for r in schema_rows(carve(bytes(content))[0])]
                except Exception:  # reported by cells
                    continue
            yield pd.DataFrame(rows, columns=["path", "table", "column", "type", "nullable", "is_control"])

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple] = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    data = ET.fromstring(carve(bytes(content))[1])
                    body = next(iter(data), ())
                    rows += [(path, decode_name(r.tag.split("}")[-1]), i, {decode_name(c.tag.split("}")[-1]): c.text for c in r}, None) for i, r in enumerate(body)]
                except Exception as e:
                    rows.append((path, None, None, None, f"{type(e).__name__}: {str(e)[:200]}"))
            yield pd.DataFrame({"path": [r[0] for r in rows], "table": [r[1] for r in rows], "row": pd.array([r[2] for r in rows], "Int64"), "cells": [r[3] for r in rows], "error": [r[4] for r in rows]})

    slim = files.select("path", "content")
    return (
        slim.mapInPandas(columns, "path string, table string, column string, type string, nullable boolean, is_control boolean"),
        slim.mapInPandas(cells, "path string, table string, row long, cells map<string,string>, error string"),
    )


def table_rows(cells: DataFrame, table: str, columns: list[str], limit: int = 0, redact_sensitive: bool = True) -> DataFrame:
    """The rows of one table as text columns, in document order; limit 0 means all."""
    rows = cells.where(F.col("table") == table)
    out = rows.select("path", "row", *((masked(F.col("cells")[c], c) if redact_sensitive else F.col("cells")[c]).alias(c) for c in columns))
    return out.orderBy("path", "row").limit(limit) if limit else out


def row_counts(cells: DataFrame) -> DataFrame:
    return cells.where("error is null").groupBy("path", "table").agg(F.count("*").alias("rows"))
