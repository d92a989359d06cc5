"""Near-duplicate components by bottom-k sketches of word shingles, confirmed on full sets.

One hash function orders all shingles. Each distinct set keeps its SKETCH smallest hashes.

1. Inverted lists: for each retained value the sets that retain it. Values that one set alone retains
   generate nothing; a set that shares too few of its values to be a partner of any other is done.
   The rest list themselves under their rarest shared values only, as many as any partner must meet in
   (the prefix filter over the order rarest first), so a passage that very many documents hold makes
   a long list only for documents that consist of little else.
2. Each list compares its members with its smallest member, and links that hold are contracted.
3. Lists with more than one component left compare members of different components: short lists as they
   are. For members of long lists the lists are drawn anew, from full sets and without any chance of a
   loss: rarest shingles first, only as many as the sizes of both partners require at that place, and only
   where members of different components meet. Variants of one text that are too far from each other
   to be linked differ in rare shingles, and so do not meet at all. These lists are contracted by rounds of
   stars before pairs are made, so a group of near copies that share rare edits makes no square of pairs.
4. Before exact work, the Jaccard similarity is estimated on the sketch of the union, with a margin
   of more than four standard deviations. A parity sketch (each shingle flips one of PARITY bits) bounds the
   symmetric difference from below, so it rejects without any chance of a loss.
5. Candidates are confirmed by exact Jaccard similarity of full sets, rebuilt from the whole texts.

A link at the threshold is lost only if two sets share fewer than need_of() of SKETCH values: binomial with
the threshold as p, n = 32, under 1 in 100,000; more similar sets are safer still. Sets of up to SKETCH shingles are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, may_hold, membership_filter, skew_join, stored, without
from .components import components
from .shingles import shingle_sets

SKETCH = 32
#: A pair at the threshold is missed with this probability at most.
MISS = 1e-5
#: Lists up to this length compare all members of different components.
SHORT = 32
#: Width of a band of set sizes, as a ratio.
BAND = 1.03
PARITY = 1024
#: Members that are verified against one copy of their hub's set.
CHUNK = 256
#: Shingles of the sets of one block, on average; a larger set makes a larger block.
BLOCK = 1 << 14
#: Values before its own that a row of a prefix carries.
BEFORE = 16

_SKETCHED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType(), False),
        T.StructField("set1", T.LongType()),
        T.StructField("set2", T.LongType()),
        T.StructField("sketch", T.ArrayType(T.LongType(), False)),
        T.StructField("odd", T.ArrayType(T.LongType(), False)),
    ]
)


def need_of(percent: int) -> int:
    """Shared values that a pair must have to be compared: the most that keep the chance of a miss under MISS."""
    p, below, k = percent / 100, 0.0, 0
    while k < SKETCH:
        below += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if below >= MISS:
            break
        k += 1
    return k


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two int64."""
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def parity(s: np.ndarray) -> np.ndarray:
    """PARITY bits, as int64: each member of the set flips one."""
    bits = np.bincount((s >> 24) & (PARITY - 1), minlength=PARITY) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _close(na: Column, nb: Column, oa: Column, ob: Column, percent: int) -> Column:
    """The parity sketches allow the threshold: flipped bits are at most the symmetric difference."""
    flips = F.aggregate(F.zip_with(oa, ob, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return flips <= F.floor((na + nb) * (100 - percent) / (100 + percent))


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


def _values(lists: pa.ChunkedArray) -> np.ndarray:
    """The members of all lists of a column, one after the other."""
    return np.concatenate([c.flatten().to_numpy() for c in lists.chunks] or [np.empty(0, np.int64)])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices: what is held at once follows a slice, not an Arrow batch."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _sketch_batches(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), ("sketch", pa.list_(pa.int64())), ("odd", pa.list_(pa.int64()))])

    digest = set_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sets = shingle_sets(_texts(b.column(1)), width)
            digests = [digest(s) if len(s) else (None, None) for s in sets]
            kept = [s[:SKETCH] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), _lists(kept), _lists([parity(s) for s in sets])],
                schema=schema,
            )

    return run


def _set_batches(width: int):
    schema = pa.schema([("set1", pa.int64()), ("set2", pa.int64()), ("set", pa.list_(pa.int64()))])

    digest = set_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sets = [s for s in shingle_sets(_texts(b.column(0)), width) if len(s)]
            digests = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), _lists(sets)], schema=schema)

    return run


def _need(n: Column, percent: int) -> Column:
    """Sketch values that a partner of a set of n shingles shares at least.

    For n of up to SKETCH it is the least over all partners: the smallest shares all it has, and the largest,
    where it is above SKETCH, may lack as many of the shared ones in its sketch as it is above.
    """
    largest = F.floor(n * 100 / percent)
    cut = F.ceil((n + largest) * percent / (100 + percent)) - F.greatest(F.lit(0), largest - SKETCH)
    return F.when(n <= SKETCH, F.least(F.ceil(n * percent / 100), cut)).otherwise(F.lit(need_of(percent)))


def _promising(percent: int) -> Column:
    """On columns na, nb, sa, sb, oa, ob: the sizes allow the threshold, and so do both sketches."""
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    met = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    small = F.greatest("na", "nb") <= SKETCH
    sizes = sizes & _close(F.col("na"), F.col("nb"), F.col("oa"), F.col("ob"), percent)
    return sizes & F.when(small, met * 100 >= F.size(F.array_union("sa", "sb")) * F.lit(percent) - 100 * (F.size(F.array_union("sa", "sb")) - F.size(union))).otherwise(met >= need_of(percent))


def _verify_batches(percent: int):
    """Rows of one hub stand together, the hub's own (b null) first."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, mine = None, None
        for batch in batches:
            a, b, sets = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            values, at = sets.values.to_numpy(), sets.offsets.to_numpy()
            found = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                s = values[at[i] : at[i + 1]]
                if y is None:
                    hub, mine = x, s.copy()
                    continue
                assert x == hub
                both = np.concatenate((mine, s))
                both.sort(kind="stable")
                met = int(np.count_nonzero(both[1:] == both[:-1]))
                if met * 100 >= (len(both) - met) * percent:
                    found.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], schema=schema)

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs(a, b) whose full sets reach the threshold. A hub's set is sent once for CHUNK members."""
    chunk = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("members") / CHUNK)))
    counted = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("members")), "a").select("a", "b", chunk.alias("chunk"))
    hubs = counted.select("a", "chunk").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", F.lit(None).cast("long").alias("b"), "set", "chunk")
    members = counted.join(sets.withColumnRenamed("node", "b"), "b").select("a", "b", "set", "chunk")
    dealt = hubs.unionByName(members).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "set").mapInArrow(_verify_batches(percent), "a long, b long")


def _block_counts(block: pa.Table) -> pa.Table:
    """(block, v, holders): the distinct shingles of one block, and how many of its sets hold them."""
    v, holders = np.unique(_values(block.column("set")), return_counts=True)
    return pa.table({"block": np.full(len(v), block.column("block")[0].as_py(), np.int64), "v": v, "holders": holders.astype(np.int64)})


def _block_prefixes(percent: int):
    """For each member of a block the rows (v, p, before) of its prefix, from the shingles that more than one set holds."""

    def run(block: pa.Table, ranks: pa.Table) -> pa.Table:
        v, df = ranks.column("v").to_numpy(), ranks.column("df").to_numpy()
        by_value = np.argsort(v)
        v, df = v[by_value], df[by_value]
        rank = np.empty(len(v), np.int64)
        rank[np.lexsort((v, df))] = np.arange(len(v))  # rarest first
        at, places, picked, before = [], [], [], []
        for i, s in enumerate(block.column("set")):
            held = np.flatnonzero(np.isin(v, s.values.to_numpy(), assume_unique=True))
            n = len(s)
            # shingles of one set alone come first in the order: they only shift positions
            alone = n - len(held)
            first = held[np.argsort(rank[held])][: max(0, -(-n * (100 - percent) // 100) + 1 - alone)]
            at.append(np.full(len(first), i))
            places.append(alone + 1 + np.arange(len(first)))
            picked.append(v[first])
            before += [v[first[max(0, j - BEFORE) : j]] for j in range(len(first))]
        rows = block.select(["node", "n", "comp", "odd"]).take(pa.array(np.concatenate(at), pa.int64()))
        rows = rows.append_column("v", pa.array(np.concatenate(picked), pa.int64())).append_column("p", pa.array(np.concatenate(places), pa.int64()))
        return rows.append_column("before", _lists(before))

    return run


def _full_pairs(members: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, tried, pairs) of members(node, comp, odd, block) of different components that can reach the threshold: a prefix join.

    Members of one list share most of their shingles, so holders of a shingle are counted block by block: a block sends
    each of its distinct shingles once, not once for each member, and gets back in how many sets all members hold it.

    A pair meets at every shingle that both prefixes hold, and need be made at the first alone. There both sizes allow
    the most, so all that holds at a later place holds there. Rows carry the BEFORE values ahead of their own: a pair
    whose rows share one of them has met before and isn't made again. Farther back a pair may be made anew, never lost.

    In the order rarest first, let position be a shingle's place in a set of n. Two sets whose first common
    shingle has positions p and q share min(n - p, m - q) + 1 at most, and must share (n + m) percent / (100 + percent).
    So a row at p meets partners of up to (n - p + 1) (100 + percent) / percent - n shingles only: rows of the larger
    set are sent to the bands of such sizes, rows of the smaller set to their own.

    links, a stored table, are the confirmed ones that gave the components. They come back with those that _contracted
    found (the table given is freed then); tried are the pairs it looked at, pairs the ones that are left.
    """
    held = sets.join(members, "node").withColumn("n", F.size("set").cast("long"))
    counts = stored(held.select("block", "set").groupBy("block").applyInArrow(_block_counts, "block long, v long, holders long"), "near-blocks")
    common = stored(counts.groupBy("v").agg(F.sum("holders").alias("df"), F.count("*").alias("blocks")).where("df > 1"), "near-common")
    ranks = skew_join(counts, common, ["v"], "blocks").select("block", "v", "df")
    prefixes = held.select("block", "node", "n", "comp", "odd", "set").groupBy("block").cogroup(ranks.groupBy("block"))
    rows = prefixes.applyInArrow(_block_prefixes(percent), "node long, n long, comp long, odd array<long>, v long, p long, before array<long>")
    rows = rows.withColumn("most", F.least("n", F.floor((F.col("n") - F.col("p") + 1) * (100 + percent) / percent) - F.col("n")))
    band = lambda x: F.floor(F.log(x.cast("double")) / F.log(F.lit(BAND)))
    least = F.ceil(F.col("n") * percent / 100)
    larger = rows.where(F.col("most") >= least).select("v", F.explode(F.sequence(band(least), band(F.col("most")))).alias("band"), *(F.col(c).alias(f"{c}b") for c in ("node", "n", "comp", "p", "odd", "before")))
    smaller = rows.where(F.col("most") == F.col("n")).select("v", band(F.col("n")).alias("band"), *(F.col(c).alias(f"{c}a") for c in ("node", "n", "comp", "p", "odd", "before")))
    larger, smaller = stored(larger, "near-larger"), stored(smaller, "near-smaller")
    free(counts, common)
    links, tried, smaller, larger, lists = _contracted(smaller, larger, links, sets, percent)
    met = _meeting(smaller.join(lists.select("v", "band"), ["v", "band"]).join(larger, ["v", "band"]), percent).where(~F.arrays_overlap("beforea", "beforeb"))
    return links, tried, met.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct()


def _meeting(met: DataFrame, percent: int) -> DataFrame:
    """Of rows of a smaller set (a) beside rows of a larger one (b), those of different components that can reach the threshold."""
    share = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    return met.where("compa <> compb and na <= nb").where(F.col("na") * 100 >= F.col("nb") * percent).where(room >= share).where(_close(F.col("na"), F.col("nb"), F.col("odda"), F.col("oddb"), percent))


def _open_lists(smaller: DataFrame, larger: DataFrame) -> DataFrame:
    """(v, band, members, pairs) of the lists that hold several components: larger rows, and pairs of different components."""
    ends = larger.select("v", "band", F.col("compb").alias("comp"), F.lit(1.0).alias("l"), F.lit(0.0).alias("s")).unionByName(
        smaller.select("v", "band", F.col("compa").alias("comp"), F.lit(0.0).alias("l"), F.lit(1.0).alias("s"))
    )
    each = ends.groupBy("v", "band", "comp").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    lists = each.groupBy("v", "band").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum("l").cast("long").alias("members"), F.sum("s").alias("smaller"), (F.sum("l") * F.sum("s") - F.sum(F.col("l") * F.col("s"))).alias("pairs")
    )
    return lists.where("low <> high and members > 0 and smaller > 0").select("v", "band", "members", "pairs")


def _contracted(smaller: DataFrame, larger: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(links, tried, smaller, larger, lists): rounds of stars within lists, each contracted before the next.

    A round compares the members of each open list with one of them, another in each round, so it makes a pair for each
    row at most. A group of near copies becomes one component in a few rounds, and one component makes no pairs. The
    rounds end where lists would make no more pairs than they have rows, or where a round has not halved the pairs:
    what is left is for the pairs, so a round that finds little loses nothing.
    """
    tried, before, turn = None, None, 0
    while True:
        lists = stored(_open_lists(smaller, larger), "near-open")
        pairs, rows = lists.agg(F.sum("pairs"), F.sum("members")).first()
        if not pairs or pairs <= rows or (before is not None and pairs > before / 2):
            return links, links.limit(0) if tried is None else tried, smaller, larger, lists
        before, turn = pairs, turn + 1
        head = F.min_by(F.struct("nodea", "na", "compa", "pa", "odda"), F.xxhash64(F.lit(turn), "nodea"))
        heads = stored(smaller.join(lists, ["v", "band"]).groupBy("v", "band").agg(head.alias("head"), F.first("members").alias("members")).select("v", "band", "members", "head.*"), "near-heads")
        stars = stored(_meeting(skew_join(larger, heads, ["v", "band"], "members"), percent).select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct(), "near-stars")
        more = stored(links.unionByName(_confirmed(stars, sets, percent)), "near-links")
        all_tried = stars if tried is None else stored(tried.unionByName(stars), "near-stars")
        comp = components(more)
        open_ = lists.select("v", "band")
        name = lambda rows, x: rows.join(open_, ["v", "band"], "left_semi").drop(f"comp{x}").join(comp.toDF(f"node{x}", f"comp{x}"), f"node{x}", "left").withColumn(f"comp{x}", F.coalesce(f"comp{x}", f"node{x}"))
        old = [links, smaller, larger, lists, heads, comp, *([] if tried is None else [tried, stars])]
        links, tried = more, all_tried
        smaller, larger = stored(name(smaller, "a"), "near-smaller"), stored(name(larger, "b"), "near-larger")
        free(*old)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row for each input row.

    Documents are linked when their sets of width-word shingles have a Jaccard similarity of percent
    hundredths at least; component_id is the smallest id reachable over links.

    Null and blank texts have no shingles and are linked with nothing: each is its own component.
    Equal sets are linked whatever their number. Rows that repeat an id stay separate rows. A null id
    is never the smallest unless a component has no other. An empty table gives no rows. Other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stored(base.mapInArrow(_sketch_batches(width), _SKETCHED), "near-sketches")
    filled = sketched.where("n > 0")
    nodes = _nodes(filled)
    links = _links(base, nodes, percent, width)
    reach = components(links)
    sized = stored(nodes.join(reach, "node").groupBy("comp").agg(F.min("rep").alias("component_id"), F.count("*").alias("size")), "near-components")
    comps = skew_join(reach, sized, ["comp"], "size").select("node", "component_id")
    named = stored(
        nodes.join(comps, "node", "left").select("set1", "set2", "copies", F.coalesce("component_id", "rep").alias("component_id")),
        "near-named",
    )
    free(nodes, links, reach, sized)
    joined = skew_join(filled.select("doc_id", "n", "set1", "set2"), named, ["set1", "set2"], "copies").select("doc_id", "n", "component_id")
    alone = sketched.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _nodes(filled: DataFrame) -> DataFrame:
    """(set1, set2, node, rep, copies, n, sketch, odd): a row for each distinct set; copies meet here by partial aggregation.

    128 bits tell sets apart. node is a name in 64 bits, the first half of them; sets that would share a name, which is
    looked for, get others.
    """
    first = [F.first(c).alias(c) for c in ("n", "sketch", "odd")]
    nodes = stored(filled.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *first).withColumn("node", F.col("set1")), "near-nodes")
    salt = 0
    while True:
        shared = stored(nodes.groupBy("node").agg(F.count("*").alias("sets")).where("sets > 1").select("node", F.lit(True).alias("shared")), "near-shared")
        if shared.isEmpty():
            free(shared)
            return nodes
        salt += 1
        other = F.when(F.col("shared"), F.xxhash64(F.lit(salt), "set1", "set2")).otherwise(F.col("node"))
        before, nodes = nodes, stored(nodes.join(shared, "node", "left").withColumn("node", other).drop("shared"), "near-nodes")
        free(before, shared)


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of docs, with all columns, whatever their names, whose id is the smallest of its component.

    An id of several rows stays if one of them would; rows without an id stay, and so do null and blank texts. An
    empty table gives no rows.
    """
    judged = near_duplicates(docs, id_col, text_col, percent)
    gone = judged.groupBy(id_col).agg(F.bool_or("kept").alias("kept")).where(~F.col("kept"))
    return without(docs, gone, id_col, "near-gone")


def _links(base: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame:
    """Confirmed links(a, b) between nodes: not all of them, but enough that components are whole."""
    values = nodes.select("node", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    mine = values.join(shared, "v")
    ranked = mine.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("shared")).join(nodes.select("node", "rep", "n", "sketch", "odd"), "node")
    lists = stored(
        # of the shared values, all but the need - 1 most frequent
        ranked.select("node", "rep", "n", "sketch", "odd", F.explode(F.slice("shared", 1, F.greatest(F.lit(0), F.size("shared") - _need(F.col("n"), percent) + 1).cast("int"))).alias("at"))
        .select("node", "rep", "n", "sketch", "odd", F.col("at.v").alias("v")),
        "near-lists",
    )
    heads = stored(lists.groupBy("v").agg(F.min(F.struct("node", "n", "sketch", "odd")).alias("head"), F.count("*").alias("members")).where("members > 1"), "near-heads")
    stars = (
        skew_join(lists, heads, ["v"], "members")
        .where("node <> head.node")
        .select(F.col("head.node").alias("a"), F.col("node").alias("b"), F.col("head.n").alias("na"), F.col("n").alias("nb"), F.col("head.sketch").alias("sa"), F.col("sketch").alias("sb"), F.col("head.odd").alias("oa"), F.col("odd").alias("ob"))
        .where(_promising(percent))
        .select("a", "b")
        .distinct()
    )
    stars = stored(stars, "near-stars")
    # sets of all listed documents, rebuilt from whole texts; the filter's few extra rows do no harm
    listed = stored(lists.select("rep").distinct(), "near-listed")
    held = membership_filter(listed, "rep", "near-filter")
    wanted = lists.select("node").distinct().join(nodes.select("node", "set1", "set2"), "node")
    again = may_hold(base, "doc_id", held)
    if not listed.where("rep is null").isEmpty():  # a filter names no null: sets that only rows without an id have are made from these
        again = again.unionByName(base.where("doc_id is null"))
    rebuilt = again.select("text").mapInArrow(_set_batches(width), "set1 long, set2 long, set array<long>")
    sets = stored(rebuilt.join(wanted, ["set1", "set2"]).dropDuplicates(["node"]).select("node", "set"), "near-sets")
    first = stored(_confirmed(stars, sets, percent), "near-links")
    comp = components(first)
    members = stored(lists.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "near-members")
    open_lists = members.groupBy("v").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("v", "members", "shingles")
    left = members.join(open_lists, "v")
    short = left.where(F.col("members") <= SHORT)
    side = lambda x: short.select("v", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("odd").alias(f"o{x}"), F.col("comp").alias(f"c{x}"))
    pairs = side("a").join(side("b"), "v").where("a < b and ca <> cb").where(_promising(percent)).select("a", "b")
    # the longest list of a member gives its block, so that sets of one block are alike; long lists make many blocks
    longest = left.where(F.col("members") > SHORT).groupBy("node", "comp").agg(F.first("odd").alias("odd"), F.max(F.struct("members", "v", "shingles")).alias("at"))
    block = F.xxhash64("at.v", F.pmod(F.xxhash64("node"), F.ceil(F.col("at.shingles") / BLOCK)))
    long = stored(longest.select("node", "comp", "odd", block.alias("block")), "near-long")
    first, tried, drawn = _full_pairs(long, sets, first, percent)
    tried = stars.unionByName(tried).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.unionByName(drawn).distinct().join(tried, ["a", "b"], "left_anti"), "near-pairs")
    second = stored(_confirmed(pairs, sets, percent), "near-links")
    links = stored(first.unionByName(second), "near-links")
    held.free()
    free(lists, heads, stars, listed, sets, first, comp, members, long, pairs, second)
    return links
