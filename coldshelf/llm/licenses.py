"""License scan: base phrases, and an exact set-similarity join with license templates.

A text is cut into overlapping blocks of words, so that any passage of half a block's words
lies whole in one block. A block matches a template when it holds at least ``threshold`` of
the template's distinct words, and the phrases that tell its license and version from others. Only words of some template can count, so each block is
reduced to those, ordered by their frequency in the corpus, rarest first. If a block matches,
one of its first words in that order, its prefix, is in the template's prefix; the join is on
those rare words, and lengths and positions rule out most pairs before words are counted.

Only DataFrame functions are used. The words of the templates are a fixed, small vocabulary;
what is broadcast is their prefixes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 128
THRESHOLD = 0.8

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Fixed values of the contract: phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Well-known sentences of public licenses, their labels, and phrases without which a
# block that holds most of a sentence's words says something else: its name, its version.
TEMPLATES = (
    ("mit", "Released under the MIT License", ("mit license",)),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        (),
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        ("apache org licenses license 2 0",),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        (),
    ),
    (
        "gpl-2.0",
        "This work is licensed under the GNU General Public License, version 2",
        ("gnu general public license", "version 2"),
    ),
    (
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license", "version 3"),
    ),
    (
        "lgpl-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3",
        ("gnu lesser general public license", "version 3"),
    ),
    (
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation",
        ("gnu general public license",),
    ),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution International License",
        ("creative commons attribution international license",),
    ),
    (
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0 international license",),
    ),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike 4 0 international license",),
    ),
    (
        "cc-by-nc-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial 4 0 international license",),
    ),
    ("reserved", "All rights reserved. No part of this publication may be reproduced without permission of the publisher", ()),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]  # distinct, rarest first
    least: int  # how many of them a match holds
    needs: tuple[str, ...]  # phrases that a match holds, all of them

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.least + 1]


def folded(text: Column) -> Column:
    """Words of a text in lower case (A-Z only), one blank between them."""
    lower = F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _CAPITALS.lower())
    return F.trim(F.regexp_replace(lower, _GAPS, " "))


def template_words(text: str) -> list[str]:
    lower = text.translate({ord(c): c.lower() for c in _CAPITALS})
    return [w for w in re.split(_GAPS, lower) if w]


def _lit_array(words) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def _words(docs: DataFrame) -> DataFrame:
    line = folded(F.col("text"))
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), line.alias("line")).withColumn(
        "words", F.when(F.col("line") == "", F.array().cast("array<string>")).otherwise(F.split("line", " ", -1))
    )


def word_order(docs: DataFrame, vocabulary: set[str]) -> list[str]:
    """The vocabulary by the number of documents with each word, rarest first."""
    wanted = _lit_array(sorted(vocabulary))
    found = (
        _words(docs)
        .select(F.explode(F.array_intersect(wanted, "words")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    counts = dict(found.collect())  # a row for each word of the templates at most
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def ordered_templates(templates, order: list[str], threshold: float) -> list[Template]:
    place = {w: i for i, w in enumerate(order)}
    out = []
    for number, (label, text, needs) in enumerate(templates):
        words = tuple(sorted(set(template_words(text)), key=place.__getitem__))
        out.append(Template(number, label, words, max(1, math.ceil(threshold * len(words) - 1e-9)), needs))
    return out


def base_columns(words: DataFrame) -> DataFrame:
    """``words`` with n_words, n_base, first_word, last_word and base_array."""
    padded = F.concat(F.lit(" "), "line", F.lit(" "))
    starts = []
    for phrase in PHRASES:
        parts = phrase.split(" ")
        # Places are looked for only where the phrase stands at all.
        here = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), _standing(parts))
        starts.append(F.when(F.contains(padded, F.lit(f" {phrase} ")), here).otherwise(F.array().cast("array<int>")))
    labels = [F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(starts, PHRASES.values())]
    places = F.concat(*starts)
    return words.withColumn("places", places).select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_array"),
    )


def _standing(parts: list[str]) -> Callable[[Column], Column]:
    def stands(start: Column) -> Column:
        found = F.lit(True)
        for place, part in enumerate(parts):
            found = found & (F.get("words", start + place) == part)
        return found

    return stands


def blocks(words: DataFrame, block: int) -> DataFrame:
    """Columns doc_id, mark, block and block_words: overlapping runs of ``block`` words."""
    step = block // 2
    count = F.greatest(F.lit(1), F.ceil((F.size("words") - step) / step).cast("int"))
    return words.select("doc_id", "mark", "words", F.explode(F.sequence(F.lit(0), count - 1)).alias("block")).select(
        "doc_id", "mark", "block", F.slice("words", F.col("block") * step + 1, block).alias("block_words")
    )


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Every block that holds enough of a template and all phrases that the template needs: doc_id, mark,
    block, label, template and containment."""
    spark = docs.sparkSession
    vocabulary = {w for _, text, _ in templates for w in template_words(text)}
    phrases = sorted({phrase for _, _, needs in templates for phrase in needs})
    order = word_order(docs, vocabulary)
    known = ordered_templates(templates, order, threshold)
    if max((len(t.words) for t in known), default=0) > block // 2:
        raise ValueError("a block must hold twice the words of the longest template")
    rows = [(w, i, t.number, t.label, list(t.words), t.least, list(t.needs)) for t in known for i, w in enumerate(t.prefix)]
    schema = "word string, place int, template int, label string, template_words array<string>, least int, needs array<string>"
    prefixes = spark.createDataFrame(rows, schema)
    # The rarest word of a block that any prefix could hold stands in the block's own prefix.
    fewest = min((t.least for t in known), default=1)
    cut = blocks(_words(docs), block).withColumn("kept", F.array_intersect(_lit_array(order), "block_words"))
    cut = cut.filter(F.size("kept") >= fewest).withColumn("said", _said(phrases, vocabulary)).select(
        "doc_id", "mark", "block", "kept", "said", F.posexplode(F.slice("kept", 1, F.size("kept") - fewest + 1)).alias("at", "word")
    )
    size, wide = F.size("kept"), F.size("template_words")
    return (
        cut.join(F.broadcast(prefixes), "word")
        .filter(F.size(F.array_except("needs", "said")) == 0)  # name and version
        .filter(size >= F.col("least"))  # length
        .filter(F.col("at") <= size - F.col("least"))  # the block's prefix for this template
        .filter(F.least(size - F.col("at"), wide - F.col("place")) >= F.col("least") - F.least("at", "place"))  # position
        .withColumn("shared", F.size(F.array_intersect("template_words", "kept")))
        .filter(F.col("shared") >= F.col("least"))
        .select("doc_id", "mark", "block", "template", "label", (F.col("shared") / wide).alias("containment"))
        .distinct()
    )


def _said(phrases: list[str], vocabulary: set[str]) -> Column:
    """The phrases that stand in a block, word for word."""
    line = F.concat(F.lit(" "), F.array_join("block_words", " "), F.lit(" "))

    def stands(phrase: str) -> Column:
        parts = sorted(set(phrase.split(" ")))
        # Most blocks lack one of the words, which is told without their line.
        inside = F.size(F.array_intersect("kept", _lit_array(parts))) == len(parts) if set(parts) <= vocabulary else F.lit(True)
        return F.when(inside, F.when(F.contains(line, F.lit(f" {phrase} ")), F.lit(phrase)))

    found = F.array(*map(stands, phrases)) if phrases else F.array().cast("array<string>")
    return F.array_compact(found)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its base phrases and template labels.

    Columns doc_id, n_words, n_base (places of phrases), first_word and last_word (least and
    greatest of their first words, from 0, else null), base_labels, labels (with the
    templates'), score (the largest share of a matching template that a block holds; 1 where
    a phrase stands). A null or empty text has no words, no labels and score 0. Rows are
    judged one by one, so repeated rows, and rows with one doc_id or none, keep their own
    result; a very long text is scanned whole, block by block; words of equal frequency are
    ordered by name; an empty table gives no rows; other columns are left out.
    """
    base = base_columns(_words(docs)).drop("words", "line", "places")
    found = matches(docs, templates, threshold, block)
    found = found.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark")).agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("mark").eqNullSafe(F.col("text_mark"))
    every = F.array_sort(F.array_union("base_array", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0)))
    return base.join(found, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base_array"), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )
