"""The package source: typed columns, filters, files, bad packages, writing, and the collections of the model."""

import gzip
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone.errors import SpecError
from marlstone.sources import packages

HEAD = '<?xml version="1.0"?><Export note="a &lt;xs:x"><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="D"><xs:complexType><xs:choice>'
TABLES = {
    "MET_METASYSTEM": [("ID", "string"), ("SystemKey", "string"), ("IsInactive", "boolean")],
    "MET_FIELDDEF": [("ID", "string"), ("dbName", "string"), ("orderNumber", "string"), ("Extra", "string")],
    "met_Relation": [("ID", "string"), ("Role", "string")],
    "$basicInfoRelation": [("ID", "string")],
    "Kinds of": [("n", "long"), ("i", "int"), ("b", "boolean"), ("f", "double"), ("d", "decimal"), ("t", "dateTime"), ("x", "base64Binary"), ("s p", "string")],
}


def package(rows, tables=TABLES, tail="</Export>"):
    from marlstone.sources.packages import _name

    body = HEAD
    for t, columns in tables.items():
        body += f'<xs:element name="{_name(t)}"><xs:complexType><xs:sequence>' + "".join(f'<xs:element name="{_name(c)}" type="xs:{k}" minOccurs="0"/>' for c, k in columns) + "</xs:sequence></xs:complexType></xs:element>"
    body += '</xs:choice></xs:complexType></xs:element></xs:schema><diffgr:diffgram xmlns:diffgr="urn:d"><D>'
    for t, cells in rows:
        body += f"<{_name(t)}>" + "".join(f"<{_name(c)}>{v}</{_name(c)}>" for c, v in cells.items()) + f"</{_name(t)}>"
    return gzip.compress((body + "</D><diffgr:before><D><met_Relation><ID>old</ID></met_Relation></D></diffgr:before></diffgr:diffgram>" + tail).encode())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    f = tmp_path_factory.mktemp("packages")
    one = [("MET_METASYSTEM", {"ID": "1", "SystemKey": "a &amp; b", "IsInactive": " TRUE "}), ("MET_METASYSTEM", {"ID": "2", "SystemKey": ""}), ("met_Relation", {"ID": "r1", "Role": "x"}), ("$basicInfoRelation", {"ID": "r2"})]
    one += [("MET_FIELDDEF", {"ID": str(i), "dbName": "n" * 50, "orderNumber": "x" if i % 2 else f" {i} ", "Extra": "e" * 40}) for i in range(10_000)]
    (f / "a.metaexport").write_bytes(package(one, tail="</Export> junk < after"))
    two = [("Kinds of", {"n": "9007199254740993", "i": "7", "b": "false", "f": "1.5", "d": "12.25", "t": "2024-01-02T03:04:05.1234567Z", "x": "AQI=", "s p": "text"}), ("Kinds of", {"n": "99999999999999999999", "i": "3000000000", "b": "maybe", "f": "x", "d": "", "t": "soon", "x": "!", "s p": ""}), ("Kinds of", {})]
    (f / "b.metaexport").write_bytes(package(two))
    (f / "_staged").mkdir()
    (f / ".hidden").write_bytes(b"no")
    return str(f)


def test_typed_table(spark, folder):
    df = packages.read_table(spark, folder, "Kinds of")
    assert [k for _, k in df.dtypes] == ["bigint", "int", "boolean", "double", "decimal(38,10)", "timestamp", "binary", "string"]
    a, b, c = df.withColumn("t", F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()
    assert tuple(a) == (9007199254740993, 7, False, 1.5, Decimal("12.25"), "2024-01-02 03:04:05.123456", bytearray(b"\x01\x02"), "text")
    assert tuple(b) == (None,) * 7 + ("",) and tuple(c) == (None,) * 8
    with pytest.raises(Exception, match="no package declares"):
        packages.read_table(spark, folder, "Nothing").collect()
    with pytest.raises(Exception, match="set the option table"):
        spark.read.format("legacy_package").schema("ID string").load(folder).collect()


def test_filters_and_columns(spark, folder):
    columns = "ID string, orderNumber string, _file string, _row long"
    read = lambda *where: packages.read_table(spark, folder, "MET_FIELDDEF", columns, where)
    few = read(("ID", "equal", "4320"), ("orderNumber", "isNotNull", None))
    assert [(r.ID, r.orderNumber, r._row, r._file.rsplit("/")[-1]) for r in few.collect()] == [("4320", " 4320 ", 4320, "a.metaexport")]
    assert read(("ID", "startsWith", "99"), ("_row", "greaterThan", 99)).count() == 110
    assert read(("ID", "inList", ["1", "2", "x"]), ("_row", "greaterThanOrEqual", 2)).count() == 1
    other = read(("_file", "equal", f"{folder}/b.metaexport"))
    assert other.count() == 0 and read(("_file", "contains", "a.meta")).count() == 10_000
    df = read()  # Spark's own filters stay with Spark: a DataFrame may be used for several queries
    assert df.where(F.col("ID") == "1").count() == 1 and df.where(F.col("ID").startswith("99") | F.col("ID").isNull()).count() == 111 and df.count() == 10_000
    kinds = lambda *where: packages.read_table(spark, folder, "Kinds of", where=where).count()
    assert (kinds(("n", "isNull", None)), kinds(("s p", "contains", "ex")), kinds(("f", "greaterThan", 1)), kinds(("b", "equal", False))) == (2, 1, 1, 1)


@pytest.mark.parametrize("test", [("gone", "equal", "x"), ("ID", "like", "x"), ("ID", "equal", 1), ("ID", "inList", ["a", None]), ("_row", "lessThan", "9")])
def test_wrong_tests_are_errors(spark, folder, test):
    with pytest.raises(Exception, match="is no test of a column"):
        packages.read_table(spark, folder, "MET_FIELDDEF", "ID string, _row long", [test]).collect()


def test_collections(spark, folder):
    got = packages.project(spark, folder)
    assert {k for k, v in got.items() if v is None} == {"entities", "relationDefs", "reports", "views", "navigation", "code", "commands"}  # unknown, not empty
    rows = [(r.id, r["name"], r.caption, r.isInactive, r.source_table) for r in got["system"].collect()]
    assert rows == [("1", "a & b", None, True, "MET_METASYSTEM"), ("2", "", None, None, "MET_METASYSTEM")]
    assert got["system"].schema["isInactive"].dataType.simpleString() == "boolean"
    fields = got["fields"].agg(F.count("*"), F.count("orderNumber"), F.sum("orderNumber"), F.count("dataType"), F.count("entityId")).first()
    assert tuple(fields) == (10_000, 5_000, sum(range(0, 10_000, 2)), 0, 0)
    assert "Extra" not in got["fields"]._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.role, r.source_table) for r in got["relations"].collect()) == [("r1", "x", "met_Relation"), ("r2", None, "$basicInfoRelation")]
    declared = packages.declared(spark, folder)
    assert declared.count() == 2 * sum(map(len, TABLES.values()))
    assert len(packages.COLLECTIONS) == 10


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = [("T 1", {"a": "x\r\ny <&> \"'", "b c": "", "_x0041_": "é日\U0001f600"}), ("$t", {"1": "z"}), ("T 1", {"a": None})] * 50
    df = spark.createDataFrame(rows, "table string, cells map<string,string>").repartition(3)
    tables = {"T 1": [("a", "string", True), ("b c", "string", True), ("_x0041_", "string", True)], "$t": [("1", "string", False)], "none": []}
    packages.write_packages(df, folder, tables)
    assert len(list((tmp_path / "out").glob("*.metaexport"))) == 3 and not (tmp_path / "out" / "_staged").exists()
    back = packages.read_table(spark, folder, "T 1").collect()
    assert sorted((tuple(r) for r in back), key=str) == sorted([("x\r\ny <&> \"'", "", "é日\U0001f600"), (None, None, None)] * 50, key=str)
    assert packages.read_table(spark, folder, "$t").count() == 50
    packages.write_packages(df.limit(1), folder, tables)
    assert packages.read_table(spark, folder, "T 1").count() + packages.read_table(spark, folder, "$t").count() == 151
    packages.write_packages(df.where(F.col("table") == "$t"), folder, tables, "overwrite")
    assert packages.read_table(spark, folder, "T 1", "a string").count() == 0 and packages.read_table(spark, folder, "$t", "`1` string").count() == 50


@pytest.mark.parametrize("row", [("T", {"a": "\x01"}), ("T", {"zz": "1"}), ("U", {"a": "1"})])
def test_nothing_is_written_of_a_failed_job(spark, tmp_path, row):
    df = spark.createDataFrame([("T", {"a": "1"})] * 20 + [row], "table string, cells map<string,string>").repartition(2)
    with pytest.raises(Exception):
        packages.write_packages(df, str(tmp_path / "o"), {"T": [("a", "string", True)]})
    assert not list(tmp_path.rglob("*.metaexport"))
    with pytest.raises(Exception, match="written from"):
        spark.range(1).write.format("legacy_package").option("declared", "{}").mode("append").save(str(tmp_path / "o"))


@pytest.mark.parametrize("body", [b"", b"<a/>", b"<xs:schema>", b"<xs:schema></xs:schema>", b"<xs:schema></xs:schema><diffgr:diffgram xmlns:diffgr='d'><D><T>"])
def test_bad_packages_are_errors(spark, tmp_path, body):
    (tmp_path / "bad.metaexport").write_bytes(gzip.compress(body))
    with pytest.raises(Exception, match="in the package|don't end|doesn't end"):
        packages.read_table(spark, str(tmp_path), "T", "a string").collect()


def test_unknown_types_are_errors(spark, folder):
    with pytest.raises(Exception, match="a package has no"):
        packages.read_table(spark, folder, "Kinds of", "n array<int>").collect()
    assert issubclass(SpecError, Exception)


def test_collections_read_packages_once(spark, folder):
    got = [v for v in packages.project(spark, folder).values() if v is not None]
    plans = [v._jdf.queryExecution().optimizedPlan().toString() for v in got]
    assert len(plans) == 3 and not any("legacy_package" in p or "PythonDataSource" in p for p in plans)
    assert all("package-cells" in f for v in got for f in v.inputFiles())
