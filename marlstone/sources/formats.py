"""Files of unknown kind: discovery, content sniffing, and a format record for each. Never raises for a bad file."""

from __future__ import annotations

import gzip
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds by extension; what each extension should hold; the size at which JSON is warned about.
KINDS = {"assembly": ["dll", "exe"], "package": ["metaexport", "gz"], "archive": ["zip"], "json": ["json"], "xml": ["xml", "config"], "markdown": ["md"], "source": ["cs", "py", "sql"]}
EXPECTED = {"zip": "ZIP", "gz": "GZip", "metaexport": "GZip", "json": "JSON", "xml": "XML", "dll": "PE", "exe": "PE"}
LARGE_JSON = 4 << 20
_MANIFEST = ("format", "profileVersion", "createdAt", "source")


def discover(spark: SparkSession, *roots: str, glob: str | None = None) -> DataFrame:
    """(path, length, content, extension, kind) of all files under the roots; a file under two roots comes once.

    Spark's reader leaves out files without a byte."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(list(roots)).dropDuplicates(["path"])
    return files.select("path", "length", "content", extension(F.col("path")).alias("extension"), kind(F.col("path")).alias("kind"))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def kind(path: Column) -> Column:
    e = extension(path)
    out = F.when(F.lit(False), "")
    for name, ends in KINDS.items():
        out = out.when(e.isin(ends), name)
    return out.otherwise("other")


def sniff(content: Column) -> Column:
    """GZip, ZIP, PE, JSON, XML, Binary or Unknown from the first bytes, behind a byte order mark and white space."""
    head = F.hex(F.substring(content, 1, 64))
    text = F.regexp_replace(head, "^(EFBBBF)?((20|09|0A|0D))*", "")
    return (
        F.when(content.isNull() | (F.length(content) == 0), "Unknown")
        .when(head.startswith("1F8B"), "GZip")
        .when(head.startswith("504B0304") | head.startswith("504B0506"), "ZIP")
        .when(head.startswith("4D5A"), "PE")
        .when(text.startswith("7B") | text.startswith("5B"), "JSON")
        .when(text.startswith("3C"), "XML")
        .otherwise("Binary")
    )


def _manifest(m: object) -> tuple[dict, list[str]]:
    """One shape for a manifest, and which of its fields are absent."""
    m = m if isinstance(m, dict) else {}
    return {k: m.get(k) for k in _MANIFEST}, [k for k in _MANIFEST if k not in m]


def _logical(physical: str, content: bytes) -> dict:
    out: dict = {"logical": "Unknown", "variant": None, "members": None, "absent": None, "warnings": [], "errors": []}
    try:
        if physical == "GZip":
            body = gzip.decompress(content)
            marks = [m for m in (b"<xs:schema", b"diffgr:diffgram", b"<NewDataSet") if m in body]
            out["logical"] = "LegacyPackage" if len(marks) >= 2 else "GZip"
            out["variant"] = ",".join(m.decode().strip("<") for m in marks) or None
        elif physical == "ZIP":
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = z.namelist()
                out["members"] = len(names)
                found = [n for n in names if n.rsplit("/", 1)[-1].lower() == "manifest.json"]
                out["logical"] = "Archive"
                if found:
                    shape, out["absent"] = _manifest(json.loads(z.read(found[0]).decode("utf-8-sig")))
                    out["logical"] = "JsonArtifact" if shape["format"] else "ArchiveWithManifest"
                    out["variant"] = None if shape["profileVersion"] is None else str(shape["profileVersion"])
        elif physical == "JSON":
            if len(content) > LARGE_JSON:
                out["warnings"].append("large JSON")
            doc = json.loads(content.decode("utf-8-sig"))
            m = doc.get("manifest") if isinstance(doc, dict) else None
            shape, out["absent"] = _manifest(m)
            out["logical"] = "JsonArtifact" if shape["format"] else "Json"
            out["variant"] = None if shape["profileVersion"] is None else str(shape["profileVersion"])
    except Exception as e:  # a bad file is a row with an error
        out["errors"].append(f"{type(e).__name__}: {str(e)[:200]}")
    return out


def detect(files: DataFrame) -> DataFrame:
    """files(path, content, ...) with sha256, physical, logical, variant, members, absent, warnings, errors.

    Bodies are opened by Python in Arrow batches; each file is looked at on its own.
    """
    schema = "logical string, variant string, members long, absent array<string>, warnings array<string>, errors array<string>"

    @F.pandas_udf(schema)
    def look(physical: pd.Series, content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_logical(p, c or b"") for p, c in zip(physical, content, strict=True)], columns=["logical", "variant", "members", "absent", "warnings", "errors"])

    known = files.withColumn("physical", sniff(F.col("content"))).withColumn("sha256", F.sha2("content", 256))
    seen = known.withColumn("d", look("physical", "content"))
    wanted = F.create_map(*(F.lit(x) for kv in EXPECTED.items() for x in kv))[extension(F.col("path"))]
    mismatch = F.when(wanted.isNotNull() & (wanted != F.col("physical")), F.array(F.concat(F.lit("extension says "), wanted, F.lit(", content is "), F.col("physical")))).otherwise(F.array().cast("array<string>"))
    return seen.select("path", F.length("content").alias("size"), "sha256", "physical", "d.logical", "d.variant", "d.members", "d.absent", F.concat("d.warnings", mismatch).alias("warnings"), "d.errors")


def members(files: DataFrame) -> DataFrame:
    """(path, member, content, error): the members of ZIP files, and JSON files as one member; a bad one is a row with an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple] = []
            for path, content in zip(f["path"], f["content"], strict=True):
                content = bytes(content or b"")
                if not content.startswith(b"PK"):
                    rows.append((path, None, content, None))
                    continue
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in z.namelist():
                            try:
                                rows.append((path, name, z.read(name), None))
                            except Exception as e:
                                rows.append((path, name, None, str(e)[:200]))
                except zipfile.BadZipFile as e:
                    rows.append((path, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["path", "member", "content", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, member string, content binary, error string")


def json_documents(files: DataFrame) -> DataFrame:
    """(path, member, json, error) of JSON members, byte order mark removed; other members are left out."""
    m = members(files)
    text = F.regexp_replace(F.decode("content", "utf-8"), "^\ufeff", "")
    rows = m.where(F.col("member").isNull() | F.lower("member").endswith(".json") | F.col("error").isNotNull())
    rows = rows.select("path", "member", text.alias("json"), "error")
    bad = F.when(F.col("error").isNull() & F.try_parse_json("json").isNull(), "not JSON").otherwise(F.col("error"))
    return rows.select("path", "member", "json", bad.alias("error"))
