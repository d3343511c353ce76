"""License scan: phrases by place, and templates by an exact set-similarity join.

A window of a text's words, of the template's length / `threshold`, matches a
template when at least `threshold` of the template's distinct words are in it,
wherever its lines break, as notices are wrapped. Blocks are pieces of the word
list that overlap by the widest window; their candidates are checked window by
window. Words of the templates are ordered by how often they occur in the whole
corpus, rarest first. A block that shares
`need` of a template's `size` words must hold one of its first
`size - need + 1`; such prefix words make the candidates. A candidate stays when
the block has enough template words (length filter) and enough words are left
after the shared place in both orders (positional filter); the overlap is then
counted in full. The templates are a short fixed list, so their index is
broadcast. Everything is SQL functions.

Defined results: a null or empty text has no words, labels or score; repeated
rows each get their labels; a null doc_id is kept; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import lower_ascii

#: Label and phrase.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

#: Label and wording of common notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
THRESHOLD = 0.8
PIECE = 128
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_in_order(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def template_words(text: str) -> list[str]:
    return sorted(set(words_in_order(text)))


def window_width(text: str, threshold: float) -> int:
    """Words that a template may stretch over, where others stand between its own."""
    return math.ceil(len(words_in_order(text)) / threshold - 1e-9)


def spaced(text: Column) -> Column:
    """The words of a text with one blank between them."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def split_words(joined: Column) -> Column:
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i):
        return reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(parts)])

    return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)


def template_index(blocks_words: DataFrame, templates, threshold: float):
    """The templates' words, rarest in the corpus first, and each template's places in that order with its need."""
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    counts = blocks_words.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("w")).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counts.collect()}  # at most a row for each word of the templates
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    place = {w: i + 1 for i, w in enumerate(order)}
    listed = []
    for number, (label, ws) in enumerate(sets):
        listed.append((number, label, sorted(place[w] for w in ws), math.ceil(threshold * len(ws) - 1e-9)))
    return order, listed


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every text."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    worded = texts.select(split_words(spaced(F.col("text"))).alias("words"))
    order, listed = template_index(worded, templates, threshold)

    rows = [(p, n, label, len(t), need, i) for n, label, t, need in listed for i, p in enumerate(t[: len(t) - need + 1])]
    index = spark.createDataFrame(rows, "place int, template int, label string, size int, need int, at int")
    widths = [window_width(text, threshold) for _, text in templates]
    whole = spark.createDataFrame([(n, t, widths[n]) for n, _, t, _ in listed], "template int, members array<int>, width int")
    first = sorted({order[p - 1] for p, *_ in rows})
    least = min(need for *_, need in listed)

    key = [F.col("doc_id"), F.xxhash64("text").alias("h"), F.length("text").alias("n_chars")]
    held = texts.withColumn("joined", spaced(F.col("text"))).filter(F.arrays_overlap(split_words(F.col("joined")), F.lit(first)))
    whole_words, step = split_words(F.col("joined")), F.lit(PIECE)
    begins = F.sequence(F.lit(0), F.floor((F.size(whole_words) - 1) / step).cast("int"))
    pieces = held.select(*key, F.posexplode(F.transform(begins, lambda i: F.slice(whole_words, i * step + 1, PIECE + max(widths)))).alias("block", "words"))
    pieces = pieces.filter(F.arrays_overlap("words", F.lit(first)))
    spots = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda x: x["word"].isin(order))
    spots = F.transform(spots, lambda x: F.struct(x["pos"].alias("pos"), F.array_position(F.lit(order), x["word"]).cast("int").alias("place")))
    pieces = pieces.select("doc_id", "h", "n_chars", "block", spots.alias("spots"))
    blocks = pieces.select("doc_id", "h", "n_chars", "block", F.array_sort(F.array_distinct("spots.place")).alias("places"), "spots")
    blocks = blocks.filter(F.size("places") >= least)
    prefix = F.slice("places", 1, F.size("places") - least + 1)
    seeds = blocks.select("*", F.posexplode(prefix).alias("here", "place"))
    met = seeds.join(F.broadcast(index), "place")
    room = F.least(F.col("size") - F.col("at"), F.size("places") - F.col("here"))
    candidates = met.filter((F.size("places") >= F.col("need")) & (room >= F.col("need")))
    candidates = candidates.select("doc_id", "h", "n_chars", "block", "places", "spots", "template", "label", "size", "need").distinct()
    checked = candidates.join(F.broadcast(whole), "template").withColumn("common", F.size(F.array_intersect("places", "members")))
    checked = checked.filter(F.col("common") >= F.col("need"))
    checked = checked.withColumn("own", F.filter("spots", lambda x: F.array_contains("members", x["place"])))

    def in_window(x):
        """Distinct words of the template in the window that begins here."""
        return F.size(F.array_distinct(F.filter("own", lambda y: (y["pos"] >= x["pos"]) & (y["pos"] < x["pos"] + F.col("width"))).getField("place")))

    matched = checked.withColumn("common", F.array_max(F.transform("own", in_window))).filter(F.col("common") >= F.col("need"))
    found = matched.groupBy("doc_id", "h", "n_chars").agg(F.collect_set("label").alias("found"), F.max(F.col("common") / F.col("size")).alias("best"))

    joined = F.concat(F.lit(" "), F.col("joined"), F.lit(" "))
    base = texts.select(*key, spaced(F.col("text")).alias("joined"))
    base = base.select("doc_id", "h", "n_chars", joined.alias("joined"), split_words(F.col("joined")).alias("words"))
    none = F.array().cast("array<int>")
    for i, (_, phrase) in enumerate(phrases):
        here = F.when(F.contains("joined", F.lit(f" {phrase} ")), _places(F.col("words"), phrase)).otherwise(none)
        base = base.withColumn(f"p{i}", here)
    every = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    labels = F.filter(
        F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(phrases)]), lambda x: x.isNotNull()
    )
    base = base.select("doc_id", "h", "n_chars", F.size("words").cast("long").alias("n_words"), every.alias("places"), labels.alias("base"))
    both = base.alias("b").join(
        found.alias("f"),
        F.col("b.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("b.h") == F.col("f.h")) & F.col("b.n_chars").eqNullSafe(F.col("f.n_chars")),
        "left",
    )
    all_labels = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return both.select(
        F.col("b.doc_id").alias("doc_id"),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(all_labels)), ",").alias("labels"),
        F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"),
    )
