"""Observed shapes: what the objects of each $type hold, from all documents that carry them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored

#: A path with at most so many different texts, each seen so often on average, has them as its vocabulary.
MOST_VALUES, OFTEN = 20, 3
#: Texts beyond this length are no members of a vocabulary.
LONGEST = 80
#: The JSON types, by name: a set of them is a number with a bit for each.
KINDS = ("array", "boolean", "null", "number", "object", "string")
_BITS = {k: 1 << KINDS.index(name) for k, name in ((list, "array"), (bool, "boolean"), (type(None), "null"), (int, "number"), (float, "number"), (dict, "object"))}
_TEXT = 1 << KINDS.index("string")
#: A task hands its counts on when it holds those of more paths than this.
HELD_PATHS = 10_000
#: A task holds so many documents as objects of Python.
SLICE = 500


class _Path:
    """What a task has counted of one path of one type."""

    __slots__ = ("below", "kinds", "latest", "long", "path", "present", "several", "texts", "values")

    def __init__(self, path: str | None) -> None:
        self.path, self.below, self.values = path, {}, set()
        self.kinds = self.texts = self.present = 0
        self.long = self.several = False
        self.latest = None

    def step(self, key: str | None, paths: dict[str, _Path]) -> _Path:
        """The path one key further, or for None one place in an array further."""
        path = f"{self.path}[*]" if key is None else key if self.path is None else f"{self.path}.{key}"
        if path not in paths:
            paths[path] = _Path(path)
        self.below[key] = paths[path]
        return paths[path]


def _count(doc: object, types: dict[str, dict[str | None, _Path]], type_key: str, most: int) -> int:
    """Count the values of one document, each at the nearest typed object around it; how many paths are new."""
    new, outer = 0, [doc]
    while outer:
        top = outer.pop()
        if type(top) is list:
            outer.extend(top)
            continue
        if type(top) is not dict:
            continue
        of = top.get(type_key)
        if type(of) is not str:
            outer.extend(top.values())
            continue
        paths = types.get(of)
        if paths is None:
            paths = types[of] = {None: _Path(None)}
        known, this = len(paths), object()
        inner = [(paths[None], top)]
        while inner:
            around, value = inner.pop()
            below = around.below
            for key, x in value.items() if type(value) is dict else zip(repeat(None), value):
                at = below.get(key) or around.step(key, paths)
                if at.latest is this:
                    at.several = True
                else:
                    at.latest = this
                    at.present += 1
                kind = type(x)
                if kind is str:
                    at.texts += 1
                    if x not in at.values:
                        if len(x) > LONGEST:
                            at.long = True
                        elif len(at.values) <= most:
                            at.values.add(x)
                    continue
                at.kinds |= _BITS[kind]
                if kind is list:
                    inner.append((at, x))
                elif kind is dict:
                    if type(x.get(type_key)) is str:
                        outer.append(x)
                    else:
                        inner.append((at, x))
        new += len(paths) - known
    return new


_COUNTS = pa.schema([("of", pa.string()), ("path", pa.string()), ("kinds", pa.int32()), ("texts", pa.int64()), ("long", pa.bool_()), ("present", pa.int64()), ("several", pa.bool_()), ("values", pa.list_(pa.string()))])


def _rows(types: dict[str, dict[str | None, _Path]]) -> pa.RecordBatch:
    found = [(of, p.path, p.kinds | _TEXT * (p.texts > 0), p.texts, p.long, p.present, p.several, list(p.values)) for of, paths in types.items() for p in paths.values() if p.path is not None]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _COUNTS)], schema=_COUNTS)


def type_shapes(docs: DataFrame, id_col: str, json_col: str, type_key: str = "$type", most: int = MOST_VALUES, often: int = OFTEN) -> DataFrame:
    """(type, path, kinds, objects, present, optional, repeated, nullable, vocabulary): the shape of each type.

    A value belongs to the nearest object around it that has a type; path is its way from there, with [*] for places in
    arrays. kinds are its JSON types, sorted. objects is how many objects of the type there are, present how many of
    them have the path; it is optional if some don't, repeated if one object can have several values there, nullable if one is
    null. vocabulary is the sorted list of its texts, if they are few and often repeated and the path holds nothing but texts
    and null; else NULL: unknown. A vocabulary is what was seen, not what is allowed.

    A document is parsed once and walked where it lies: a task counts its documents' values by type and path and hands on these counts,
    with at most most + 1 different texts each, so neither values nor objects are stored or shuffled, however deep they lie.
    Text that is no JSON has no shape. Objects are told apart by where they are, so id_col is not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, held, parsed = {}, 0, json.JSONDecoder().raw_decode
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                for text in batch.column(0).slice(i, SLICE).to_pylist():
                    if text is not None:
                        held += _count(parsed(text)[0], types, type_key, most)
                    if held > HELD_PATHS:
                        yield _rows(types)
                        types, held = {}, 0
        if types:
            yield _rows(types)

    # VARIANT alone says what is JSON; where Python could read a text otherwise it gets the value's text
    v = docs.select(F.col(json_col).alias("text"), F.try_parse_json(json_col).alias("v"))
    as_is = F.substring("text", 1, 1).isin("{", "[") & ~F.col("text").contains("\\u")
    texts = v.select(F.when(F.col("v").isNotNull(), F.when(as_is, F.col("text")).otherwise(F.to_json("v"))).alias("doc"))
    counts = stored(texts.mapInArrow(run, "of string, path string, kinds int, texts long, long boolean, present long, several boolean, values array<string>"), "shapes")
    merged = [F.bit_or("kinds").alias("kinds"), F.sum("texts").alias("texts"), F.bool_or("long").alias("long"), F.sum("present").alias("present"), F.bool_or("several").alias("several")]
    shape = counts.groupBy("of", "path").agg(*merged)
    names = F.filter(F.array(*(F.when(F.col("kinds").bitwiseAND(1 << i) != 0, F.lit(k)) for i, k in enumerate(KINDS))), lambda k: k.isNotNull())
    shape = shape.withColumn("kinds", names)
    values = counts.select("of", "path", F.explode("values").alias("value")).distinct()
    first = values.withColumn("at", F.row_number().over(Window.partitionBy("of", "path").orderBy("value"))).where(F.col("at") <= most + 1)
    seen = first.groupBy("of", "path").agg(F.array_sort(F.collect_list("value")).alias("vocabulary"))
    objects = counts.where(F.col("path") == type_key).groupBy("of").agg(F.sum("present").alias("objects"))  # every object of a type has that path
    out = shape.join(seen, ["of", "path"], "left").join(objects, "of")
    n = F.size("vocabulary")
    only = ~F.col("long") & (F.size(F.array_except("kinds", F.array(F.lit("string"), F.lit("null")))) == 0)
    is_known = only & (n <= most) & (F.col("texts") >= often * n)
    return out.select(
        F.col("of").alias("type"), "path", "kinds", "objects", "present", (F.col("present") < F.col("objects")).alias("optional"), (F.col("path").contains("[*]") | F.col("several")).alias("repeated"),
        F.array_contains("kinds", "null").alias("nullable"), F.when(is_known, F.col("vocabulary")).alias("vocabulary"),
    )
