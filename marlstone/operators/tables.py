"""Intermediate tables in the folder that driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Attribute of a stored table's DataFrame: the folder, until it is freed.
_PATH = "_marlstone_path"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.

    Where it is unset a local master gets a temporary folder; a cluster gets an error, as its machines would not
    see each other's files.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    there = f"file://{tempfile.mkdtemp(prefix='marlstone-')}"
    spark.conf.set("spark.checkpoint.dir", there)
    return there


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store; nothing where the session has ended."""
    _kept.pop(path, None)
    jvm, sc = spark._jvm, spark.sparkContext
    if jvm is None or sc._jsc is None:
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


#: Folders that are deleted at the end of the driver's process, if nothing removes them before.
_kept: dict[str, SparkSession] = {}


@atexit.register
def _remove_kept() -> None:
    for path, spark in list(_kept.items()):
        with contextlib.suppress(Exception):  # the session may be gone already
            remove(spark, path)


def new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a new folder of the shared store. remove() deletes it, or else the end of the driver's process."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    _kept[path] = spark
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there.

    The table outlives lost executors. free() deletes it, or else the end of the driver's process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _kept[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables that stored() wrote; no DataFrame that reads them may be used afterwards."""
    for t in tables:
        path = getattr(t, _PATH, None)
        if path:
            remove(t.sparkSession, path)
            delattr(t, _PATH)
