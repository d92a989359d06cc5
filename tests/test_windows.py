"""Streams of files, late and out of order, against the same on a table; replayed batches change nothing."""

import json
import os
import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.errors import SpecError
from marlstone.streaming import windows

SCHEMA = "id long, k string, at timestamp, v int"
T0 = datetime(2024, 1, 1)


def event(i, k, seconds, v=1):
    return {"id": i, "k": k, "at": None if seconds is None else (T0 + timedelta(seconds=seconds)).isoformat() + "Z", "v": v}


class Files:
    """Files that a stream reads one at a time, in the order of their names."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        path.mkdir()

    def add(self, *events):
        file = self.path / f"{self.n:04d}.json"
        file.write_text("\n".join(map(json.dumps, events)))
        os.utime(file, (1_700_000_000 + self.n,) * 2)  # a stream reads files by age
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(self.path))

    def table(self):
        return self.spark.read.schema(SCHEMA).json(str(self.path))


@pytest.fixture
def files(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # state stores of a test are many small files
    yield Files(spark, tmp_path / "in")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def drained(writer):
    q = writer.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def uncommit(checkpoint, number):
    """As after a crash: the batch was planned, its commit is not there."""
    for name in (str(number), f".{number}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_windows(spark, files, tmp_path):
    rng = random.Random(2)
    for f in range(4):  # out of order within the delay of 100 s
        files.add(*(event(f * 50 + i, rng.choice("ab"), max(0, f * 60 + rng.randrange(-60, 60)), i) for i in range(50)), event(1000 + f, "a", None))
    files.add(event(2000, "z", 100_000))  # ends all windows
    made = windows.windowed(files.stream(), "at", ["k"], "60 seconds", "20 seconds", "100 seconds", n=F.count("*"), v=F.sum("v"))
    drained(made.writeStream.foreachBatch(windows.writes_once(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")))
    got = windows.read_batches(spark, str(tmp_path / "out"), "start timestamp, end timestamp, k string, n long, v long")
    want = windows.windowed(files.table().where("k <> 'z'"), "at", ["k"], "60 seconds", "20 seconds", n=F.count("*"), v=F.sum("v"))
    assert rows(got) == rows(want) and got.count() > 20
    with pytest.raises(SpecError):
        windows.windowed(files.table(), "at", [], "60 seconds")


def test_late_rows_go_to_a_side_output(spark, files, tmp_path):
    files.add(event(1, "a", 0), event(2, "a", 1000))
    files.add(event(3, "a", 899), event(4, "a", 900), event(5, "a", 1200), event(6, "a", None))  # the mark is 1000, the delay 100
    files.add(event(7, "a", 1099), event(8, "a", 1100))
    files.add(event(9, "a", 0))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    ids = lambda name: [r.id for r in windows.read_batches(spark, f"{out}/{name}", SCHEMA).orderBy("id").collect()]
    drained(windows.split_late(files.stream(), "at", 100, out, cp))
    assert (ids("on_time"), ids("late")) == ([1, 2, 4, 5, 8], [3, 6, 7, 9])
    # a crash before the last batch was committed, and one within it: it is split as it was
    last = windows.numbers(spark, f"{out}/mark")[-1]
    uncommit(tmp_path / "cp", last)
    shutil.rmtree(tmp_path / "out" / "mark" / f"batch={last:012d}")
    files.add(event(10, "a", 1100), event(11, "a", 1000))
    drained(windows.split_late(files.stream(), "at", 100, out, cp))
    assert (ids("on_time"), ids("late")) == ([1, 2, 4, 5, 8, 10], [3, 6, 7, 9, 11])


def test_interval_join(spark, files, tmp_path):
    rng = random.Random(4)
    for f in range(4):
        files.add(*(event(f * 40 + i, rng.choice(["a", "b", None]), f * 100 + rng.randrange(-50, 100), rng.randrange(2)) for i in range(40)))
    files.add(event(999, "z", 50_000, 0), event(998, "z", 50_000, 1))
    pick = lambda df: windows.interval_join(df.where("v = 0").drop("v"), df.where("v = 1").drop("v"), "k", "at", 30, "200 seconds")
    table = files.table().collect()
    brute = sorted((a.id, b.id) for a in table if a.v == 0 for b in table if b.v == 1 and a.k == b.k and a.k and timedelta(0) <= b["at"] - a["at"] <= timedelta(seconds=30))
    assert rows(pick(files.table()).select("left_id", "right_id")) == sorted(brute, key=str) and len(brute) > 50
    s = files.stream()
    joined = windows.interval_join(s.where("v = 0").drop("v"), files.stream().where("v = 1").drop("v"), "k", "at", 30, "200 seconds").select("left_id", "right_id")
    drained(joined.writeStream.foreachBatch(windows.writes_once(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")))
    assert rows(windows.read_batches(spark, str(tmp_path / "out"), "left_id long, right_id long")) == sorted(brute, key=str)
    with pytest.raises(SpecError):
        windows.interval_join(files.table(), files.table(), "k", "at", 0)


def test_attempts_are_consumed_once(spark, files, tmp_path):
    files.add(event(1, "a", 0), event(2, "b", 1), event(1, "a", 0))
    files.add(event(1, "a", 20), event(3, "c", 30))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    start = lambda: drained(windows.consume(files.stream(), ["id", "k"], "at", "1 hour", out, cp))
    got = lambda: rows(windows.read_batches(spark, out, SCHEMA).select("id"))
    start()
    assert got() == [(1,), (2,), (3,)]
    done = windows.numbers(spark, out)
    stamps = {n: (tmp_path / "out" / f"batch={n:012d}" / "_SUCCESS").stat().st_mtime_ns for n in done}
    # replayed: the commit of the last batch is lost, its output is there
    uncommit(tmp_path / "cp", done[-1])
    start()
    assert got() == [(1,), (2,), (3,)] and {n: (tmp_path / "out" / f"batch={n:012d}" / "_SUCCESS").stat().st_mtime_ns for n in done} == stamps
    # a crash within the batch: parts without _SUCCESS are not read, and the replay writes the batch whole
    uncommit(tmp_path / "cp", done[-1])
    (tmp_path / "out" / f"batch={done[-1]:012d}" / "_SUCCESS").unlink()
    assert windows.numbers(spark, out) == done[:-1]
    files.add(event(3, "c", 40), event(4, "d", 50))
    start()
    assert got() == [(1,), (2,), (3,), (4,)]
    assert rows(windows.consumed(files.table(), ["id", "k"], ["at"], ["at"]).select("id")) == [(1,), (2,), (3,), (4,)]
