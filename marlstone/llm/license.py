"""License scans by diagonal voting (DataFrame functions only).

1. Every rolling k-gram of words of every text is hashed and joined to the positions where the
   templates hold that gram. The template table is a constant of a few hundred rows, so it is broadcast.
   A vote counts only if the gram's words are equal, not just the hash.
2. Votes are aggregated by offset diagonal (text position less template position): a passage that
   copies a template votes again and again for one diagonal.
3. Neighbouring diagonals merge, as an inserted or missing word shifts the rest of a passage.
4. Spans are verified: the distinct template positions that agree are the measured coverage. A phrase counts
   where all of its grams agree on one diagonal, which is where its words stand consecutively.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 2
#: Diagonals up to this far apart merge.
GAP = 3
#: Share of a template's grams that a passage must hold, in per cent; templates under SHORT grams, which
#: differ from each other by a word, need SHORT_COVERAGE.
COVERAGE = 60
SHORT, SHORT_COVERAGE = 10, 90

#: Fixed values of the contract: phrase and label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Public notices and license openings, by label.
TEMPLATES = {
    "apache-2.0-notice": ["Licensed under the Apache License, Version 2.0"],
    "gpl-3.0-notice": ["This work is licensed under the GNU General Public License, version 3"],
    "mit-notice": ["Released under the MIT License", "Licensed under the MIT License"],
    "cc-by-4.0-notice": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "cc-by-nc-4.0-notice": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa-4.0-notice": ["Licensed under CC BY-SA 4.0"],
    "all-rights-reserved": ["All rights reserved"],
    "apache-2.0-header": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ],
    "mit-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction"
    ],
    "bsd-text": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "gpl-header": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation"
    ],
}
#: What no word holds (fixed value of the contract).
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text):
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, GAPS), "")


def template_rows(phrases: dict[str, str], templates: dict[str, list[str]]) -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, is_phrase, grams, at, gram) for each gram of each template of two words or more."""
    import re

    out, t = [], 0
    for label, text, phrase in [(v, k, True) for k, v in phrases.items()] + [(k, x, False) for k, v in templates.items() for x in v]:
        ws = [w for w in re.split(GAPS, text.lower()) if w]
        out += [(t, label, phrase, len(ws) - K + 1, i, " ".join(ws[i : i + K])) for i in range(len(ws) - K + 1)]
        t += 1
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None, coverage: int = COVERAGE) -> DataFrame:
    """One row for each input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of phrases, first_word and last_word are the smallest and largest start of one,
    base_labels are the phrases' labels, labels add those of templates of which a passage holds coverage per
    cent of the grams (SHORT_COVERAGE for short ones); score is the greatest coverage found, at most 1, or 0.

    Null text has no words. Rows that repeat id and text get the same result, a null id included. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    schema = "template int, label string, is_phrase boolean, grams int, t int, gram string"
    grams = F.broadcast(spark.createDataFrame(template_rows(phrases, templates), schema).withColumn("h", F.xxhash64("gram")).withColumnRenamed("gram", "wanted"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("doc"), _words(F.col(text_col)).alias("ws"))
    # neighbours by arrays_zip and explode: grams are made one row at a time, without a lambda
    pairs = rows.select("id", "doc", F.posexplode(F.arrays_zip(F.col("ws").alias("x"), F.slice("ws", 2, F.greatest(F.size("ws") - 1, F.lit(0))).alias("y"))).alias("p", "g"))
    gram = F.concat_ws(" ", F.col("g.x"), F.col("g.y"))
    votes = (
        pairs.where(F.col("g.y").isNotNull())
        .select("id", "doc", "p", gram.alias("gram"), F.xxhash64(gram).alias("h"))
        .join(grams, "h")
        .where("gram = wanted")
        .select("id", "doc", "template", "label", "is_phrase", "grams", "t", (F.col("p") - F.col("t")).alias("diagonal"))
    )
    lines = votes.groupBy("id", "doc", "template", "label", "is_phrase", "grams", "diagonal").agg(F.collect_set("t").alias("at"))
    # merge diagonals within GAP of the one before, template by template
    before = Window.partitionBy("id", "doc", "template").orderBy("diagonal")
    merged = (
        lines.withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(before) <= GAP).eqNullSafe(F.lit(True)).cast("int"))
        .withColumn("span", F.sum(1 - F.col("new")).over(before))
        .groupBy("id", "doc", "template", "label", "is_phrase", "grams", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("agree"),
            F.sum(F.when(F.col("is_phrase") & (F.size("at") == F.col("grams")), 1).otherwise(0)).alias("places"),
            F.min(F.when(F.size("at") == F.col("grams"), F.col("diagonal"))).alias("first"),
            F.max(F.when(F.size("at") == F.col("grams"), F.col("diagonal"))).alias("last"),
        )
    )
    share = F.col("agree") / F.col("grams")
    is_place = F.col("is_phrase") & (F.col("places") > 0)
    found = F.when(F.col("is_phrase"), F.col("places") > 0).otherwise(share * 100 >= F.when(F.col("grams") < SHORT, F.lit(SHORT_COVERAGE)).otherwise(F.lit(coverage)))
    per_doc = merged.groupBy("id", "doc").agg(
        F.sum("places").alias("n_base"),
        F.min(F.when(is_place, F.col("first"))).alias("first_word"),
        F.max(F.when(is_place, F.col("last"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(is_place, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(found, F.col("label"))))).alias("labels"),
        F.max(F.when(found, F.least(F.lit(1.0), share))).alias("score"),
    )
    per_doc = per_doc.withColumnsRenamed({"id": "id_", "doc": "doc_"})
    counted = rows.select("id", "doc", F.size("ws").cast("long").alias("n_words"))
    out = counted.join(per_doc, (F.col("doc") == F.col("doc_")) & F.col("id").eqNullSafe(F.col("id_")), "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
