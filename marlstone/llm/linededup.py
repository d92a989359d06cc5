"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

A line occurrence goes if the same line, or one within the edit bound, occurs earlier (whether or not that
occurrence itself stays); the earliest stays. Order is by document id, then by position in the text. Lines are
compared lower-cased, with each run of white space as one space, trimmed. Lines of every length with a word
take part; the edit bound grows with the line: none below NEAR_CHARS characters, where any two words
lie within an edit of each other by chance, one from there on.

1. Exact: lines meet by a 128-bit hash, with partial aggregation.
2. Who can have a partner: two lines within one edit, the shorter of n characters, agree in the first
   n / 2 of them or in the last n - n / 2. Distinct lines that share no such half with another line of a fitting
   length have no partner; no variant of them is made.
3. Deletion neighbourhood: each remaining distinct line emits hashed keys of its one-character
   deletions, all but those in a half that must agree. Lines that agree after deleting the character at the same
   position are a substitution apart; a line that equals a deletion of another is an insertion apart. A key is made of
   hashes around a block of about sqrt(n) characters and of the variant within it, so n keys cost n sqrt(n)
   characters. The earliest line under a key decides for all lines under it: no pairs are made within a group.
4. The one edit between a line and its witness is verified on the texts, at the place that the key names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, flagged, free, fresh, may_hold, membership_filter, skew_join, stored

#: The edit bound is one for lines of this many characters or more, and none for shorter ones.
NEAR_CHARS = 32


def normalised_text(text: Column) -> Column:
    """The text lower-cased, with each run of white space but newlines as one space; lines still to be trimmed."""
    return F.lower(F.when(text.rlike("[\t\x0b-\r]|  "), F.regexp_replace(text, "[ \t\x0b-\r]+", " ")).otherwise(text))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("doc"), text.alias("text"))


def _lines(documents: DataFrame, *keep: str) -> DataFrame:
    """Lines with a word: position, normalised line, hashes and length."""
    lines = documents.select(*keep, F.posexplode(F.split(normalised_text(F.col("text")), "\n")).alias("at", "raw")).where(F.trim("raw") != "")
    lines = lines.select(*keep, "at", F.trim("raw").alias("line"))
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(7), "line")).withColumn("n", F.length("line"))


#: Hashes of a line's first and last half, as the shorter (or equal) of two lines and as the longer.
_HALVES = ("front", "back", "front1", "back1")


def _halves() -> list[Column]:
    line, n = F.col("line"), F.col("n")

    def pair(short: Column) -> list[Column]:
        front = F.floor(short / 2).cast("int")
        back = short - front
        return [F.xxhash64(F.lit(1), short, F.substring(line, F.lit(1), front)), F.xxhash64(F.lit(2), short, F.substring(line, n - back + 1, back))]

    return [h.alias(name) for h, name in zip([*pair(n), *pair(n - 1)], _HALVES, strict=True)]


def _candidates(firsts: DataFrame) -> DataFrame:
    """(h1, h2, n, first, low, high, swap, longer, shorter) of distinct lines that may have a partner.

    Only deletions at positions low to high can make them meet; swap: with a line of the same length,
    longer and shorter: this one is the longer or the shorter of the two.
    """
    slots = firsts.select("h1", "h2", "n", F.posexplode(F.array(*_HALVES)).alias("which", "k"))
    own = F.when(F.col("which") < 2, F.col("h1"))
    met = slots.groupBy("k").agg(F.min(own).alias("one"), F.max(own).alias("two"), F.bool_or(F.col("which") >= 2).alias("has_longer"))
    met = stored(met.where("one is not null and (one <> two or has_longer)"), "line-halves")
    held = membership_filter(met, "k", "line-filter")
    near = may_hold(slots, "k", held).join(met, "k")
    is_own, front = F.col("which") < 2, F.col("which") % 2 == 0
    cuts = ~is_own | (F.col("one") != F.col("two"))
    middle = F.floor(F.col("n") / 2).cast("int")
    ranges = near.groupBy("h1", "h2", "n").agg(
        # where the fronts agree the deletion is behind them, and the other way about
        F.min(F.when(cuts, F.when(front, middle).otherwise(1))).alias("low"),
        F.max(F.when(cuts, F.when(front, F.col("n")).otherwise(middle + 1))).alias("high"),
        F.bool_or(is_own & (F.col("one") != F.col("two"))).alias("swap"),
        F.bool_or(~is_own).alias("longer"),
        F.bool_or(is_own & F.col("has_longer")).alias("shorter"),
    )
    out = stored(ranges.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]), "line-candidates")
    free(met)
    held.free()
    return out


def _width(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("int")


def _keys(texts: DataFrame) -> DataFrame:
    """(k, role, ord, i): the hashed variants of each candidate line, and the place of the deletion.

    role 0 keys name a deletion and its position; roles 1 and 2 name a string, which a line is (1) or
    becomes by a deletion (2). The blocks are those of the longer line; a frame hashes what is around one.
    """
    sub = F.substring
    line, n, b, w = F.col("line"), F.col("n"), F.col("b"), F.col("w")
    begin = b * w + 1
    blocks = texts.where("swap or longer").withColumn("w", _width(n))
    blocks = blocks.withColumn("b", F.explode(F.sequence(F.floor((F.col("low") - 1) / w).cast("int"), F.floor((F.col("high") - 1) / w).cast("int"))))
    blocks = blocks.select(
        "ord", "swap", "longer", "w", begin.alias("begin"),
        F.xxhash64(n, b, sub(line, F.lit(1), begin - 1), sub(line, begin + w, n)).alias("frame"),
        sub(line, begin, w).alias("mid"),
        F.greatest(F.lit(1), F.col("low") - begin + 1).alias("i0"),
        F.least(w, n - begin + 1, F.col("high") - begin + 1).alias("i1"),
    )
    cut = blocks.select("*", F.explode(F.sequence("i0", "i1")).alias("i"))
    left, right = sub(F.col("mid"), F.lit(1), F.col("i") - 1), sub(F.col("mid"), F.col("i") + 1, w)
    swap = F.when(F.col("swap"), F.struct(F.xxhash64(F.lit(0), "frame", "i", left, F.lit("\n"), right).alias("k"), F.lit(0).alias("role")))
    drop = F.when(F.col("longer"), F.struct(F.xxhash64(F.lit(1), "frame", F.concat(left, right)).alias("k"), F.lit(2).alias("role")))
    at = F.col("begin") + F.col("i") - 1
    cut = cut.select("ord", at.alias("at"), F.explode(F.array(swap, drop)).alias("s")).where("s is not null").select("s.k", "s.role", "ord", F.col("at").alias("i"))
    # the shorter line lacks one character of one block of the longer's
    whole = texts.where("shorter").withColumn("w", _width(n + 1))
    whole = whole.withColumn("b", F.explode(F.sequence(F.lit(0), F.floor(n / w).cast("int"))))
    size = F.least(w, n + 2 - begin) - 1
    frame = F.xxhash64(n + 1, b, sub(line, F.lit(1), begin - 1), sub(line, begin + size, n))
    whole = whole.select(F.xxhash64(F.lit(1), frame, sub(line, begin, size)).alias("k"), F.lit(1).alias("role"), "ord", F.lit(0).alias("i"))
    return cut.unionByName(whole)


def _one_edit(line: Column, other: Column, role: Column, i: Column) -> Column:
    """The edit that the key stands for makes both lines equal: a character replaced (0), inserted (1) or deleted (2) at i."""
    part = lambda x, first, last: F.substring(x, first, last)
    end = F.length(line) + 1
    behind = lambda x, skip: part(x, i + F.lit(1) - skip.cast("int"), end)
    return (part(line, F.lit(1), i - 1) == part(other, F.lit(1), i - 1)) & (behind(line, role == 1) == behind(other, role == 2)) & ((role != 0) | (F.length(line) == F.length(other)))


def _near(documents: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one edit."""
    wanted = _candidates(firsts.where(F.col("n") >= NEAR_CHARS))
    # texts come from the documents of first occurrences
    docs_of = stored(wanted.select(F.col("first.doc").alias("doc")).distinct(), "line-holders")
    holders = membership_filter(docs_of, "doc", "line-filter")
    names = membership_filter(wanted, "h1", "line-filter")
    found = may_hold(_lines(may_hold(documents, "doc", holders), "doc").select("h1", "h2", "line"), "h1", names)
    texts = found.groupBy("h1", "h2").agg(F.first("line").alias("line")).join(wanted, ["h1", "h2"])
    # numbers that follow the order of first occurrences, without counting: partitions are ranges, and so are their ids
    texts = texts.repartitionByRange("first", "h1", "h2").sortWithinPartitions("first", "h1", "h2").withColumn("ord", F.monotonically_increasing_id())
    texts = stored(texts, "line-texts")
    # lines under a key differ in one character there, or are insertions of one string: their number is that of characters
    under = Window.partitionBy("k")
    least = lambda role: F.min(F.when(F.col("role") == role, F.struct("ord", "i"))).over(under)
    met = _keys(texts).select("role", "ord", "i", least(0).alias("w0"), least(1).alias("w1"), least(2).alias("w2"))
    witness = F.when(F.col("role") == 0, F.col("w0")).when(F.col("role") == 1, F.col("w2")).otherwise(F.col("w1"))
    pairs = met.select("role", "ord", witness.alias("w"), F.when(F.col("role") == 1, F.col("w2.i")).otherwise(F.col("i")).alias("i"))
    pairs = pairs.where("w.ord < ord").select("role", "ord", "i", F.col("w.ord").alias("w")).distinct()
    other = texts.select(F.col("ord").alias("w"), F.col("line").alias("other"))
    near = pairs.join(texts.select("ord", "h1", "h2", "line"), "ord").join(other, "w").where(_one_edit(F.col("line"), F.col("other"), F.col("role"), F.col("i")))
    out = stored(near.select("h1", "h2").distinct().withColumn("near", F.lit(True)), "line-near")
    free(wanted, docs_of, texts)
    holders.free()
    names.free()
    return out


def _dropped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, gone, n_exact, n_near): the positions of dropped lines of each document that has any."""
    documents = _documents(docs, id_col, text_col)
    pos = F.struct(F.col("id").isNull().alias("last"), "id", "doc", "at")
    lines = stored(_lines(documents, "id", "doc").select("id", "doc", "at", "h1", "h2", "n", *_halves()), "lines")
    first = [F.first(c).alias(c) for c in ("n", *_HALVES)]
    firsts = stored(lines.groupBy("h1", "h2").agg(F.min(pos).alias("first"), F.count("*").alias("times"), *first), "line-firsts")
    near = _near(documents, firsts)
    decided = firsts.join(near, ["h1", "h2"], "left").where("times > 1 or near").select("h1", "h2", "first", "times", F.coalesce("near", F.lit(False)).alias("near"))
    decided = stored(decided, "line-decided")
    dropped = skew_join(lines.select("h1", "h2", pos.alias("pos")), decided, ["h1", "h2"], "times").where("near or first < pos")
    out = stored(
        dropped.select("pos.id", "pos.doc", "pos.at", (F.col("first") < F.col("pos")).alias("exact"))
        .distinct()
        .groupBy("id", "doc")
        .agg(F.collect_set("at").alias("gone"), F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near")),
        "line-dropped",
    )
    free(lines, firsts, near, decided)
    return out


def _joined(docs: DataFrame, dropped: DataFrame, id_col: str, doc: str, names: list[str]) -> DataFrame:
    """docs with the columns gone, n_exact and n_near of dropped under names; texts without a dropped line are not shuffled."""
    key, other = fresh(docs, "_key"), fresh(docs, "_id")
    held = membership_filter(dropped, "doc", "line-filter")
    flag = fresh(docs, "_flag")
    seen = flagged(docs, doc, held, flag)
    gone = dropped.select(F.col("id").alias(other), F.col("doc").alias(key), *(F.col(c).alias(n) for c, n in zip(("gone", "n_exact", "n_near"), names, strict=True)))
    hit = seen.where(F.col(flag)).join(gone, (F.col(doc) == F.col(key)) & F.col(id_col).eqNullSafe(F.col(other)), "left").drop(flag, key, other)
    if held.blocks is None:
        return hit
    types = {f.name: f.dataType for f in gone.schema}
    rest = seen.where(~F.col(flag)).drop(flag).select("*", *(F.lit(None).cast(types[n]).alias(n) for n in names))
    return rest.unionByName(hit)


def _rest(text: Column, gone: Column) -> Column:
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.concat_ws("\n", left))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_exact, n_near, text): a row for each input row, its text without the dropped lines.

    n_lines counts the text's lines, n_exact and n_near those dropped as equal to, and as within one edit
    of, an earlier line. Remaining lines stand as they were, joined by a newline; lines without a word always stay.

    Null text counts as empty, one line, nothing to drop. Rows that repeat id and text are one document
    and get the same result. Null ids come after all others. An empty table gives no rows. Other columns
    are ignored. A line of n characters that may have a partner costs n sqrt(n).
    """
    dropped = _dropped(docs, id_col, text_col)
    same = _joined(_documents(docs, id_col, text_col), dropped, "id", "doc", ["gone", "n_exact", "n_near"])
    return same.select(
        F.col("id").alias(id_col),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        _rest(F.col("text"), F.col("gone")).alias("text"),
    )


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all columns, whatever their names, and the remaining text; a document whose every word was dropped goes.

    A document without dropped lines stays as it is, a null text too. An empty table gives no rows.
    """
    dropped = _dropped(docs, id_col, text_col)
    doc = fresh(docs, "_doc")
    keyed = docs.withColumn(doc, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    names = [fresh(keyed, c) for c in ("gone", "n_exact", "n_near")]
    same = _joined(keyed, dropped, id_col, doc, names)
    gone, rest = F.col(names[0]), fresh(same, "_rest")
    left = same.withColumn(rest, _rest(F.col(text_col), gone))
    left = left.where(gone.isNull() | (F.length(F.regexp_replace(rest, SPACE, "")) > 0))
    return left.select(*(F.col(rest).alias(c) if c == text_col else F.col(c) for c in docs.columns))
