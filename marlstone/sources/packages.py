"""A data source for legacy packages: gzipped streams with a declared XML schema and the rows of many tables.

    spark.dataSource.register(PackageSource)
    spark.read.format("legacy_package").option("table", "T").schema("ID string, Caption string").load(folder)

A task streams one package, element by element. Columns that the schema doesn't name are not made. The option where,
a JSON list of [column, test, value] that must all hold, is applied while rows are read, and a test of _file leaves
out whole packages. (Spark's own hook for filters keeps those of one query of a DataFrame for the next one that has
none to push, which loses rows; so the filters are part of what is read.) Without a
schema the table has its declared columns, in their declared types. A cell that is missing is NULL, an empty one is
an empty string; a cell that its type can't hold is NULL. _file and _row (the place among the package's rows of
the table) may be asked for as well. The option catalog=true gives the declared columns in place of rows.
"""

from __future__ import annotations

import base64
import gzip
import json
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime
from decimal import Decimal
from functools import lru_cache
from typing import Any
from xml.etree.ElementTree import XMLPullParser
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from ..errors import SpecError
from ..functions.text import safe_long, tri_state
from ..operators.tables import stored
from .legacy import decode_name, schema_rows

CATALOG = "file string, table string, column string, type string, nullable boolean"
CELLS = "_file string, table string, cells map<string,string>"
CHUNK = 1 << 16
ROWS = 4096
#: Declared types and the types they are read as; others are text.
TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "short": T.ShortType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "float": T.DoubleType(), "decimal": T.DecimalType(38, 10),
    "dateTime": T.TimestampType(), "date": T.DateType(), "base64Binary": T.BinaryType(),
}


def _place(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri) if ":" in uri.split("/", 1)[0] else (arrow_fs.LocalFileSystem(), uri)


def _listed(folder: str) -> list[str]:
    """The packages of a folder, or the one that is named; names that start with _ or . are none."""
    where, path = _place(folder)
    info = where.get_file_info(path)
    if info.type == arrow_fs.FileType.File:
        return [folder]
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(folder)
    found = [i.base_name for i in where.get_file_info(arrow_fs.FileSelector(path)) if i.type == arrow_fs.FileType.File]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(found) if n[0] not in "_."]


@lru_cache(4096)
def _decoded(tag: str) -> str:
    """The name behind an element's tag: few tags, many elements."""
    return decode_name(tag.split("}")[-1])


class _Package:
    """One package, read once from front to end: schema() first, then rows()."""

    def __init__(self, uri: str) -> None:
        where, path = _place(uri)
        self.raw = where.open_input_stream(path)
        self.body = gzip.GzipFile(fileobj=self.raw)
        self.held = b""

    def _until(self, pattern: bytes) -> re.Match | None:
        """Read on until the pattern is in what is held; forget what stands before it, but for a tail that may begin it."""
        while not (m := re.search(pattern, self.held)):
            more = self.body.read(CHUNK)
            if not more:
                return None
            self.held = self.held[-64:] + more
        return m

    def schema(self) -> str:
        m = self._until(rb"<xs:schema")
        if m is None:
            raise ValueError("no schema in the package")
        self.held = self.held[m.start() :]
        parts = [self.held]
        while b"</xs:schema>" not in self.held:
            more = self.body.read(CHUNK)
            if not more:
                raise ValueError("the schema doesn't end")
            parts.append(more)
            self.held = self.held[-16:] + more
        whole = b"".join(parts)
        end = whole.index(b"</xs:schema>") + len(b"</xs:schema>")
        self.held = whole[end:]
        return whole[:end].decode("utf-8", "replace")

    def rows(self) -> Iterator[tuple[str, dict[str, str]]]:
        """(table, cells) of each row; the second element of a row set and whatever follows is not read."""
        m = self._until(rb"<diffgr:diffgram")
        if m is None:
            raise ValueError("no rows in the package")
        parser, more, depth, data_set = XMLPullParser(("start", "end")), self.held[m.start() :], 0, None
        while more:
            parser.feed(more)
            for event, e in parser.read_events():
                depth += 1 if event == "start" else -1
                if event == "start" and depth == 2:
                    data_set = e
                elif event == "end" and depth == 2:
                    yield _decoded(e.tag), {_decoded(c.tag): c.text or "" for c in e}
                    data_set.clear()
                elif event == "end" and depth == 1:
                    return
            more = self.body.read(CHUNK)
        raise ValueError("the rows don't end")

    def __enter__(self) -> _Package:
        return self

    def __exit__(self, *_) -> None:
        self.raw.close()


def _time(x: str) -> datetime:
    at = datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", x.strip()))
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def _whole(bits: int) -> Callable[[str], int]:
    def read(x: str) -> int:
        v = int(x.strip())
        if not -(1 << bits - 1) <= v < 1 << bits - 1:
            raise ValueError(x)
        return v

    return read


def _decimal(kind: T.DecimalType) -> Callable[[str], Decimal]:
    def read(x: str) -> Decimal:
        v = round(Decimal(x.strip()), kind.scale)
        if len(v.as_tuple().digits) > kind.precision:
            raise ValueError(x)
        return v

    return read


def _converter(kind: T.DataType) -> Callable[[str], Any]:
    if isinstance(kind, T.DecimalType):
        return _decimal(kind)
    made = {
        T.StringType: str, T.LongType: _whole(64), T.IntegerType: _whole(32), T.ShortType: _whole(16), T.DoubleType: float, T.TimestampType: _time,
        T.DateType: lambda x: date.fromisoformat(x.strip()[:10]), T.BooleanType: lambda x: {"true": True, "1": True, "false": False, "0": False}[x.strip().lower()],
        T.BinaryType: lambda x: base64.b64decode(x, validate=True),
    }.get(type(kind))
    if made is None:
        raise SpecError(f"a package has no {kind.simpleString()}")
    return made


def _cell(read: Callable[[str], Any], text: str | None) -> Any:
    if text is None:
        return None
    try:
        return read(text)
    except (ValueError, ArithmeticError, KeyError):
        return None


#: Tests that a row's own cells decide; NULL passes none but isNull, as in SQL.
_TESTS: dict[str, Callable[[Any, Any], bool]] = {
    "equal": lambda x, v: x == v, "greaterThan": lambda x, v: x > v, "greaterThanOrEqual": lambda x, v: x >= v, "lessThan": lambda x, v: x < v, "lessThanOrEqual": lambda x, v: x <= v,
    "inList": lambda x, v: x in v, "startsWith": lambda x, v: x.startswith(v), "contains": lambda x, v: v in x, "isNotNull": lambda x, v: True,
}
Test = tuple[str, str, Any]


def _passes(value: Any, test: str, wanted: Any) -> bool:
    if test == "isNull":
        return value is None
    return value is not None and _TESTS[test](value, wanted)


@dataclass
class _File(InputPartition):
    uri: str


#: What a column's values may be compared with.
_COMPARED: dict[type, tuple[type, ...]] = {T.StringType: (str,), T.LongType: (int,), T.IntegerType: (int,), T.ShortType: (int,), T.DoubleType: (int, float), T.BooleanType: (bool,)}


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.folder, self.schema = options["path"], schema
        self.catalog = options.get("catalog", "false").lower() == "true"
        self.table = options.get("table")
        if not self.catalog and not self.table and "cells" not in options:
            raise SpecError("a package is read by table: set the option table")
        self.tests: list[Test] = [(c, test, v) for c, test, v in json.loads(options.get("where", "[]"))]
        for c, test, v in self.tests:
            kind = schema[c].dataType if c in schema.names else None
            fits = test in ("isNull", "isNotNull") or all(isinstance(x, _COMPARED.get(type(kind), ())) for x in (v if test == "inList" else [v]))
            if kind is None or test not in (*_TESTS, "isNull") or not fits:
                raise SpecError(f"where: {[c, test, v]} is no test of a column that is read")

        # all tables in one reading: the columns that are wanted of each
        self.wanted: dict[str, list[str]] | None = json.loads(options["cells"]) if "cells" in options else None

    def partitions(self) -> list[_File]:
        wanted = [(test, v) for c, test, v in self.tests if c == "_file"]
        return [_File(u) for u in _listed(self.folder) if all(_passes(u, k, v) for k, v in wanted)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        rows = self._declared(partition.uri) if self.catalog else self._cells(partition.uri) if self.wanted is not None else self._rows(partition.uri)
        held: list[tuple] = []
        for r in rows:
            held.append(r)
            if len(held) == ROWS:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    def _declared(self, uri: str) -> Iterator[tuple]:
        with _Package(uri) as p:
            for r in schema_rows(p.schema()):
                yield (uri, *r)

    def _cells(self, uri: str) -> Iterator[tuple]:
        with _Package(uri) as p:
            p.schema()
            for table, cells in p.rows():
                if table in self.wanted:
                    yield uri, table, [(c, cells[c]) for c in self.wanted[table] if c in cells]

    def _rows(self, uri: str) -> Iterator[tuple]:
        fields = [(f.name, _converter(f.dataType)) for f in self.schema if f.name not in ("_file", "_row")]
        own = [(c, k, v) for c, k, v in self.tests if c != "_file"]
        at = -1
        with _Package(uri) as p:
            p.schema()
            for table, cells in p.rows():
                if table != self.table:
                    continue
                at += 1
                made = {"_file": uri, "_row": at} | {c: _cell(read, cells.get(c)) for c, read in fields}
                if all(_passes(made[c], k, v) for c, k, v in own):
                    yield tuple(made[c] for c in self.schema.names)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


@dataclass
class _Staged(WriterCommitMessage):
    name: str | None


_NOT_XML = re.compile("[^\\t\\n\\r\\x20-\\ud7ff\\ue000-\\ufffd\\U00010000-\\U0010ffff]")


@lru_cache(4096)
def _name(name: str) -> str:
    """A name as XML takes it: other characters, and an underscore that would read as one, as _xHHHH_."""
    out = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)|[^A-Za-z0-9_.\-]", lambda m: "".join(f"_x{u:04X}_" for u in memoryview(m[0].encode("utf-16-le")).cast("H")), name)
    return out if re.match("[A-Za-z_]", out) else f"_x{ord(out[0]):04X}_{out[1:]}"


class _Writer(DataSourceWriter):
    """A package for each task that has rows; packages are moved into the folder when all tasks have ended."""

    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool) -> None:
        if schema.simpleString() != "struct<table:string,cells:map<string,string>>":
            raise SpecError("a package is written from (table string, cells map<string,string>)")
        self.folder, self.declared, self.overwrite = options["path"].rstrip("/"), json.loads(options["declared"]), overwrite

    def write(self, iterator: Iterator[Row]) -> _Staged:
        known = {t: {c for c, *_ in columns} for t, columns in self.declared.items()}
        out = None
        name = f"{uuid.uuid4().hex}.metaexport"
        for r in iterator:
            if r.table not in known or not known[r.table].issuperset(r.cells):
                raise SpecError(f"{r.table}: a table or column that isn't declared")
            if out is None:
                where, path = _place(f"{self.folder}/_staged")
                where.create_dir(path, recursive=True)
                out = gzip.GzipFile(fileobj=where.open_output_stream(f"{path}/{name}"), mode="wb", mtime=0)
                out.write(self._head().encode())
            cells = "".join(f"<{_name(c)}>{self._text(v)}</{_name(c)}>" for c, v in r.cells.items() if v is not None)
            out.write(f"<{_name(r.table)}>{cells}</{_name(r.table)}>".encode())
        if out is None:
            return _Staged(None)
        out.write(b"</NewDataSet></diffgr:diffgram></NewDataSet>")
        raw = out.fileobj
        out.close()
        raw.close()
        return _Staged(name)

    @staticmethod
    def _text(value: str) -> str:
        if m := _NOT_XML.search(value):
            raise ValueError(f"no character of XML: U+{ord(m[0]):04X}")
        return escape(value, {"\r": "&#13;"})

    def _head(self) -> str:
        tables = ""
        for t, columns in self.declared.items():
            cells = "".join(f'<xs:element name="{_name(c)}" type="xs:{kind}"{' minOccurs="0"' if nullable else ""}/>' for c, kind, nullable in columns)
            tables += f'<xs:element name="{_name(t)}"><xs:complexType><xs:sequence>{cells}</xs:sequence></xs:complexType></xs:element>'
        schema = f'<xs:schema id="NewDataSet" xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="NewDataSet"><xs:complexType><xs:choice minOccurs="0" maxOccurs="unbounded">{tables}</xs:choice></xs:complexType></xs:element></xs:schema>'
        return f'<NewDataSet>{schema}<diffgr:diffgram xmlns:diffgr="urn:schemas-microsoft-com:xml-diffgram-v1"><NewDataSet>'

    def commit(self, messages: list[_Staged | None]) -> None:
        where, path = _place(self.folder)
        where.create_dir(path, recursive=True)
        names = [m.name for m in messages if m and m.name]
        if self.overwrite:
            for uri in _listed(self.folder):
                where.delete_file(_place(uri)[1])
        for n in names:
            where.move(f"{path}/_staged/{n}", f"{path}/{n}")
        self._unstage()

    def abort(self, messages: list[_Staged | None]) -> None:
        self._unstage()

    def _unstage(self) -> None:
        where, path = _place(f"{self.folder}/_staged")
        if where.get_file_info(path).type == arrow_fs.FileType.Directory:
            where.delete_dir(path)


class PackageSource(DataSource):
    """Reads one table of all packages of a folder; writes (table, cells) rows as packages, the option declared naming their columns."""

    @classmethod
    def name(cls) -> str:
        return "legacy_package"

    def schema(self) -> T.StructType | str:
        if self.options.get("catalog", "false").lower() == "true":
            return CATALOG
        for uri in _listed(self.options["path"]):
            with _Package(uri) as p:
                own = [(c, kind) for t, c, kind, _ in schema_rows(p.schema()) if t == self.options.get("table")]
            if own:
                return T.StructType([T.StructField(c, TYPES.get(kind, T.StringType())) for c, kind in own])
        raise SpecError(f"no package declares the table {self.options.get('table')}")

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options, schema, overwrite)


def declared(spark: SparkSession, folder: str) -> DataFrame:
    """(file, table, column, type, nullable): what each package declares; its rows are not read."""
    spark.dataSource.register(PackageSource)
    return spark.read.format("legacy_package").option("catalog", "true").schema(CATALOG).load(folder)


def read_table(spark: SparkSession, folder: str, table: str, columns: str | T.StructType | None = None, where: list[Test] = ()) -> DataFrame:
    """The rows of one table that pass all tests; columns is a schema of those that are wanted, or all as declared."""
    spark.dataSource.register(PackageSource)
    reader = spark.read.format("legacy_package").option("table", table).option("where", json.dumps(list(where)))
    return (reader.schema(columns) if columns is not None else reader).load(folder)


def write_packages(rows: DataFrame, folder: str, tables: dict[str, list[tuple[str, str, bool]]], mode: str = "append") -> None:
    """rows(table, cells) as packages, one for each partition; tables: declared columns (name, type, nullable) of each table."""
    rows.sparkSession.dataSource.register(PackageSource)
    rows.select("table", "cells").write.format("legacy_package").option("declared", json.dumps(tables)).mode(mode).save(folder)


#: The collections of the model, the tables that they come from, and the column behind each of their
#: columns as (name, column, kind). unknown: the package holds it in a form that isn't decoded.
COLLECTIONS: dict[str, tuple[tuple[str, ...], list[tuple[str, str | None, str]]]] = {
    "system": (("MET_METASYSTEM",), [("id", "ID", "text"), ("name", "SystemKey", "text"), ("caption", "Caption", "text"), ("version", "Version", "text"), ("rootFolderId", "rootFolderId", "text"), ("isInactive", "IsInactive", "truth")]),
    "entities": (
        ("MET_TYPEDEF",),
        [
            ("id", "ID", "text"), ("name", "DbName", "text"), ("caption", "caption", "text"), ("dbName", "DbName", "text"), ("systemId", "systemId", "text"), ("parentId", "parentid", "text"), ("isDynamic", "isDynamic", "truth"),
            ("isDeleted", "IsDeleted", "truth"), ("defaultFieldId", "DefaultFieldId", "text"), ("previewFieldId", "previewFieldId", "text"), ("defaultReportId", "defaultReportId", "text"),
        ],
    ),
    "fields": (
        ("MET_FIELDDEF",),
        [
            ("id", "ID", "text"), ("name", "dbName", "text"), ("caption", "caption", "text"), ("dbName", "dbName", "text"), ("entityId", "typeDefId", "text"), ("orderNumber", "orderNumber", "integer"), ("fieldInfoType", "fieldInfoType", "text"),
            ("relationType", "relationType", "text"), ("dataType", None, "unknown"), ("nullable", None, "unknown"), ("defaultValue", None, "unknown"),
        ],
    ),
    "relationDefs": (
        ("MET_RELATIONDEF",),
        [
            ("id", "ID", "text"), ("title", "Title", "text"), ("reverseTitle", "ReverseTitle", "text"), ("sourceEntity", "SourceTypeId", "text"), ("targetEntity", "DestTypeId", "text"), ("relationType", "RelationType", "text"),
            ("max", "Max", "integer"), ("isBilateral", "isBilateral", "truth"), ("sourceFieldDefId", "SourceFieldDefId", "text"),
        ],
    ),
    "relations": (("met_Relation", "$basicInfoRelation"), [("id", "ID", "text"), ("sourceId", "SourceId", "text"), ("destId", "DestId", "text"), ("role", "Role", "text"), ("relationDefId", "RelationDefId", "text")]),
    "reports": (
        ("met_Report",),
        [
            ("id", "ID", "text"), ("name", "Name", "text"), ("systemId", "systemId", "text"), ("reportType", "reportType", "text"), ("searchObjectId", "SearchObjectId", "text"), ("query", None, "unknown"), ("template", None, "unknown"),
            ("parameters", None, "unknown"), ("customColumns", None, "unknown"),
        ],
    ),
    "views": (("MET_TYPEVIEWENTITY",), [("id", "ID", "text"), ("name", "Name", "text"), ("entityId", "TypeDefId", "text"), ("parentId", "ParentId", "text"), ("layout", None, "unknown")]),
    "navigation": (
        ("MET_FOLDER",),
        [
            ("id", "ID", "text"), ("name", "Name", "text"), ("parentId", "ParentId", "text"), ("path", "Path", "text"), ("orderNo", "OrderNo", "integer"), ("folderType", "FolderType", "text"), ("reportId", "ReportId", "text"),
            ("containingTypeDefId", "ContainingTypeDefId", "text"),
        ],
    ),
    "code": (
        ("MET_METACODE",),
        [
            ("id", "ID", "text"), ("systemId", "SystemId", "text"), ("targetObjectId", "TargetObjectId", "text"), ("codeLocation", "CodeLocation", "text"), ("codeLayer", "CodeLayer", "text"), ("codeLanguage", "CodeLanguage", "text"),
            ("addressInTarget", "AddressInTarget", "text"), ("code", None, "unknown"),
        ],
    ),
    "commands": (("MET_METACOMMAND",), [("id", "ID", "text"), ("caption", "Caption", "text"), ("targetId", "TargetId", "text"), ("systemId", "SystemId", "text"), ("location", "Location", "text"), ("isGlobal", "IsGlobal", "truth")]),
}
_KINDS: dict[str, tuple[str, Callable[[Column], Column]]] = {"text": ("string", lambda c: c), "integer": ("long", safe_long), "truth": ("boolean", tri_state), "unknown": ("string", lambda c: c)}


def project(spark: SparkSession, folder: str, collections: dict | None = None) -> dict[str, DataFrame | None]:
    """The collections of the model from the packages of a folder, each with source_file and source_table.

    A mapping is compiled against what the packages declare: only declared columns are read, and one that no package
    declares is NULL of its type. A collection of which no table is declared is None: unknown, not empty.
    Every package is read once, for all tables, and the cells that are wanted are stored.
    """
    # distinct tables and columns: as many as the schema has, however many packages and rows there are
    there: dict[str, set[str]] = {}
    for r in declared(spark, folder).select("table", "column").distinct().collect():
        there.setdefault(r.table, set()).add(r.column)
    chosen = collections or COLLECTIONS
    wanted: dict[str, set[str]] = {}
    for tables, columns in chosen.values():
        for t in tables:
            if t in there:
                wanted.setdefault(t, set()).update(c for _, c, _ in columns if c in there[t])
    if not wanted:
        return dict.fromkeys(chosen)
    spark.dataSource.register(PackageSource)
    option = json.dumps({t: sorted(c) for t, c in wanted.items()})
    rows = stored(spark.read.format("legacy_package").option("cells", option).schema(CELLS).load(folder), "package-cells")
    return {name: _collection(rows, tables, columns, wanted) for name, (tables, columns) in chosen.items()}


def _collection(cells: DataFrame, tables: tuple[str, ...], columns: list[tuple[str, str | None, str]], there: dict[str, set[str]]) -> DataFrame | None:
    out = None
    for table in tables:
        if table not in there:
            continue
        rows = cells.where(F.col("table") == table)
        made = [(_KINDS[kind][1](F.try_element_at("cells", F.lit(c))) if c in there[table] else F.lit(None)).cast(_KINDS[kind][0]).alias(name) for name, c, kind in columns]
        part = rows.select(*made, F.col("_file").alias("source_file"), F.lit(table).alias("source_table"))
        out = part if out is None else out.unionByName(part)
    return out
