"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word pair of a text is joined by hash to the positions it has in the
templates, and the text of the pair is compared too. A match votes for the diagonal
(position in the text - position in the template). Votes are summed per document,
template and diagonal as a bitmap of template positions; neighbouring diagonals, as
a missing or an additional word makes them, are merged into one span, whose bitmap
tells how much of the template it covers. A base phrase stands exactly where one
diagonal has all its votes.

The text is read and cut into words once. A document's diagonals are summed in the
task that reads it before anything is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The phrases of the contract and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Sentences by which licenses are named in texts.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2.0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "under the terms of the gnu general public license version 2": "gpl-2.0",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "licensed under a creative commons attribution 4.0 international license": "cc-by-4.0",
    "licensed under a creative commons attribution sharealike 4.0 international license": "cc-by-sa-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
}
# Share of a notice's word pairs that a span must have.
COVERED = 0.7
# How far apart two diagonals may be to belong to one span.
NEIGHBOURS = 2
# Word pairs in a part of a template, and pairs of all templates up to which they are broadcast.
PART, MOST_SENT = 63, 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _template_pairs(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """One row per word pair of a template, and one row (no template) for a document's end.

    Votes are bits of a long, so a template of many pairs is cut into parts; a pair keeps its place in the whole.
    """
    rows = [(None, None, None, None, None, None, None, "")]
    for number, (phrase, label) in enumerate([*BASE.items(), *templates.items()]):
        words = re.findall(WORD, phrase.translate(str.maketrans(_UPPER, _LOWER)))
        for at, pair in enumerate(zip(words, words[1:])):
            rows.append((number, label, number < len(BASE), at // PART, at, 1 << at % PART, len(words) - 1, " ".join(pair)))
    kind = "template int, label string, base boolean, part int, at int, vote long, pairs int, pair string"
    pairs = spark.createDataFrame(rows, kind).withColumn("hash", F.xxhash64("pair"))
    return F.broadcast(pairs) if len(rows) <= MOST_SENT else pairs


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), 1)


def diagonals(docs: DataFrame, templates: Mapping[str, str]) -> DataFrame:
    """Votes per (doc_id, mark, template, part, diagonal); template null: the text's number of words,
    and as `met` the number of equal rows.

    `mark` is the hash of the text, so that rows with one doc_id stay apart unless equal.
    """
    words = F.col("words")
    count = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: F.concat_ws(" ", a, b))
    closed = F.concat(pairs, F.array(F.lit("")))  # the empty pair stands for the text's end
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    rolled = marked.select("doc_id", "mark", F.size("words").alias("n_words"), closed.alias("pairs"))
    places = rolled.select("doc_id", "mark", "n_words", F.posexplode_outer("pairs").alias("place", "pair"))
    hashed = places.withColumn("hash", F.xxhash64("pair"))
    met = hashed.join(_template_pairs(docs.sparkSession, templates), ["hash", "pair"])
    offset = F.when(F.col("template").isNull(), F.col("n_words")).otherwise(F.col("place") - F.col("at"))
    return (
        met.select("doc_id", "mark", "template", "label", "base", "pairs", "part", offset.alias("diagonal"), "vote")
        .groupBy("doc_id", "mark", "template", "label", "base", "pairs", "part", "diagonal")
        .agg(F.bit_or("vote").alias("votes"), F.count("*").alias("met"))
    )


def spans(votes: DataFrame) -> DataFrame:
    """Neighbouring diagonals of one document and template merged; base phrases stay as they are."""
    line = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal", "part")
    ends = F.coalesce(F.col("base"), F.lit(True))
    apart = ends | F.col("before").isNull() | (F.col("diagonal") - F.col("before") > NEIGHBOURS)
    chained = votes.withColumn("before", F.lag("diagonal").over(line)).withColumn(
        "span", F.sum(apart.cast("int")).over(line)
    )
    of_template = ["doc_id", "mark", "template", "label", "base", "pairs", "span"]
    parts = chained.groupBy(*of_template, "part").agg(
        F.min("diagonal").alias("start"), F.bit_count(F.bit_or("votes")).alias("covered"), F.max("met").alias("met")
    )
    return parts.groupBy(*of_template).agg(
        F.min("start").alias("start"), F.sum("covered").alias("covered"), F.max("met").alias("met")
    )


def scan(docs: DataFrame, templates: Mapping[str, str] = NOTICES) -> DataFrame:
    """License mentions of every document (doc_id, text).

    `n_base` counts the places of base phrases; `first_word` and `last_word` are the
    smallest and largest of their starts; `base_labels` and `labels` are distinct, sorted and
    joined by commas; `score` is the largest share of a template found. Null and empty
    texts have no words and score 0. Every row comes out, repeated ones and those
    without an id too. `templates` are texts of any length with their labels, beside the base phrases;
    a word pair is looked for wherever it stands in them. Empty tables give no rows; further columns are ignored.
    """
    share = F.col("covered") / F.col("pairs")
    found = F.when(F.col("template").isNull(), F.lit(False)).when(F.col("base"), share >= 1.0).otherwise(share >= COVERED)
    base = found & F.col("base")
    text = lambda condition: F.concat_ws(
        ",", F.array_sort(F.collect_set(F.when(condition, F.col("label"))))
    )
    return (
        spans(diagonals(docs, templates))
        .groupBy("doc_id", "mark")
        .agg(
            F.max(F.when(F.col("template").isNull(), F.col("start"))).cast("long").alias("n_words"),
            F.count(F.when(base, True)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            text(base).alias("base_labels"),
            text(found).alias("labels"),
            F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.least(share, F.lit(1.0)))), F.lit(0.0)).alias("score"),
            F.max(F.when(F.col("template").isNull(), F.col("met"))).alias("rows"),
        )
        .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .drop("mark", "rows", "row")
    )
