"""Quality rules with cross-document line frequency (DataFrame functions only).

Base rules count within a text. The method counts across texts: lines are normalised and hashed, each
host (the source column) counts the distinct documents that hold a line, lines above the limits are
taken out, and documents that keep too little are rejected as depleted.

Documents of a host are distinct if their texts differ: exact copies count as one document, near copies
as several, since documents that share most of their lines may as well be pages of one template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, free, fresh, let, skew_join, stored, without, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is above the limits if more than this many documents of its host, and more than this share, hold it.
MAX_DOCS = 20
MAX_DOCS_PER_MILLE = 2
#: A document is depleted if this share of its words, or more, stood in such lines.
DEPLETED_PERCENT = 80


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words(ws: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array, first finds included.

    Window hashes are sorted with their positions; positions of repeated ones are sorted again, and each
    covers three words less the overlap with the next: n log n in the words of a text.
    """
    n = F.size(ws)
    window = lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeats(s: Column) -> Column:
        h = lambda i: F.get(s, i)["h"]
        twice = F.filter(s, lambda e, i: e["h"].eqNullSafe(h(i + 1)) | e["h"].eqNullSafe(h(i - 1)))
        return let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeats)


def base_counts(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """The keep columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = docs.select(*keep, F.coalesce(text, F.lit("")).alias("text"))
    t = t.withColumn("ws", words(F.col("text")))
    # lines with a word
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    names = [c for c in t.columns if c not in ("text", "ws")]
    out = t.select(
        *names,
        F.size("ws").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("ws")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.withColumn("base_failed", failed)


def normalised_line(line: Column) -> Column:
    """Lower-cased, digits as 0, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACE, " "))


def frequent_lines(lines: DataFrame, hosts: DataFrame, max_docs: int, per_mille: int) -> DataFrame:
    """(host, line, docs_with) above the limits; lines(host, doc, line), hosts(host, docs)."""
    counted = lines.groupBy("host", "line", "doc").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("docs_with"))
    counted = counted.where(F.col("docs_with") > max_docs)
    return counted.join(hosts, "host").where(F.col("docs_with") * 1000 > F.col("docs") * per_mille).select("host", "line", "docs_with")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS, per_mille: int = MAX_DOCS_PER_MILLE, depleted: int = DEPLETED_PERCENT) -> DataFrame:
    """One row for each input row: id, n_words, the base counts, base_failed, n_frequent_words, kept.

    n_frequent_words: words in lines that more than max_docs distinct documents of the host, and more than
    per_mille of its documents, hold. kept: not base_failed, and under depleted per cent of the words are such.

    Null text has no words and fails. A null host is a host like any other. Rows that repeat host and text
    count once across documents; each still gets its row. An empty table gives no rows. Other columns are ignored.
    """
    judged = _judged(docs, id_col, text_col, host_col, max_docs, per_mille, depleted)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_frequent_words", "kept"
    )


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of docs, with all columns, whatever their names, that quality_rules() keeps.

    A null text goes. Rows that repeat share one verdict, which depends on host and text alone. An empty table gives no rows.
    """
    judged = _judged(docs, id_col, text_col, host_col, MAX_DOCS, MAX_DOCS_PER_MILLE, DEPLETED_PERCENT)
    rejected = judged.where(~F.col("kept")).select(F.struct("host", "doc", "doc2").alias("key"))
    key = fresh(docs, "_key")
    named = docs.withColumn(key, F.struct(*_host_and_doc(text_col, host_col)))
    return without(named, rejected.withColumnRenamed("key", key), key, "rules-rejected").select(*docs.columns)


def _host_and_doc(text_col: str, host_col: str) -> tuple[Column, Column, Column]:
    """The host, a null one apart from an empty one, and 128 bits of the text."""
    host, text = F.col(host_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))
    return F.coalesce(F.concat(F.lit("="), host), F.lit("")).alias("host"), F.xxhash64(text).alias("doc"), F.xxhash64(F.lit(7), text).alias("doc2")


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_docs: int, per_mille: int, depleted: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), *_host_and_doc(text_col, host_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = stored(base_counts(rows, F.col("text"), F.col("id"), F.col("host"), F.col("doc"), F.col("doc2")), "rules-counts")
    # lines of a document in one pass: hashes and words of each
    raw = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    per_line = F.transform(raw, lambda x: F.struct(F.xxhash64(normalised_line(x)).alias("line"), F.size(words(x)).alias("w")))
    lines = stored(
        rows.select("host", "doc", F.explode(per_line).alias("at")).select("host", "doc", F.col("at.line").alias("line"), F.col("at.w").alias("w")),
        "rules-lines",
    )
    hosts = counts.groupBy("host").agg(F.count("*").alias("docs"))
    frequent = stored(frequent_lines(lines, hosts, max_docs, per_mille), "rules-frequent")
    # equal texts of a host are one document here: its lines carry the number of its rows
    taken = stored(
        skew_join(lines, frequent, ["host", "line"], "docs_with")
        .groupBy("host", "doc")
        .agg(F.sum("w").alias("w"))
        .join(counts.groupBy("host", "doc").agg(F.count("*").alias("copies")), ["host", "doc"])
        .select("host", "doc", F.floor(F.col("w") / F.col("copies")).alias("frequent")),
        "rules-taken",
    )
    free(lines, frequent)
    out = counts.join(taken, ["host", "doc"], "left").withColumn("n_frequent_words", F.coalesce("frequent", F.lit(0)).cast("long"))
    gone = F.col("n_frequent_words") * 100 >= F.col("n_words") * depleted
    return out.withColumn("kept", ~F.col("base_failed") & ~gone)
