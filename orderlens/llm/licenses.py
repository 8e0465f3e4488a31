"""License scans: phrases, and a set-similarity join of text blocks with licence notices."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.text import ALNUM_WORD, alnum_words, let, row_hash

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Public licence notices. A notice has at most ``stride`` words (see ``scan``).
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and or sell copies of the Software",
    "apache": "you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http www apache org licenses LICENSE 2.0 Unless required by applicable law or agreed to in "
    "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
    "CONDITIONS OF ANY KIND, either express or implied.",
    "gpl": "This program is free software: you can redistribute it and or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "at your option any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer.",
    "cc-by": "This work is licensed under the Creative Commons Attribution International License. To view a copy "
    "of this license, visit http creativecommons org licenses by or send a letter to Creative Commons",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http mozilla org MPL",
}


def words_of(text: str) -> list[str]:
    return re.findall(ALNUM_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _places(words: Column, phrase: list[str]) -> Column:
    """Positions at which the phrase's words stand one after another."""

    def here(i: Column) -> Column:
        same = [F.get(words, i + k) == F.lit(w) for k, w in enumerate(phrase)]
        test = same[0]
        for s in same[1:]:
            test = test & s
        return test

    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(phrase)), here)
    possible = F.size(words) >= len(phrase)
    for w in phrase:
        possible = possible & F.array_contains(words, w)
    return F.when(possible, found).otherwise(F.array().cast("array<int>"))


def _blocks(words: Column, size: int, stride: int) -> Column:
    """Overlapping blocks: any ``size - stride`` consecutive words lie within one of them."""
    last = F.greatest(F.ceil((F.size(words) - size) / F.lit(stride)).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(words, k * stride + 1, size))


def rarity_order(blocks: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words, rarest first by the number of blocks of the whole corpus that hold them.

    The result has one entry per word of the templates, whatever the corpus.
    """
    vocabulary = sorted(vocabulary)
    known = F.array(*map(F.lit, vocabulary))
    counts = (
        blocks.select(F.explode(F.array_intersect("block", known)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    seen = {r["word"]: r["n"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def prefix_rows(templates: dict[str, str], order: list[str], threshold: float) -> list[tuple]:
    """(word, label, place in the template's order, words, needed words, template) of the prefix words.

    A block with at least ``needed`` of a template's words has one of its first
    ``size - needed + 1`` words in the global order.
    """
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text in templates.items():
        words = sorted(set(words_of(text)), key=rank.__getitem__)
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        for place, word in enumerate(words[: len(words) - need + 1]):
            rows.append((word, label, place, len(words), need, words))
    return rows


def similar_blocks(
    spark: SparkSession,
    docs: DataFrame,
    templates: dict[str, str],
    threshold: float = 0.8,
    size: int = 256,
    stride: int = 128,
    text: str = "text",
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keys``, label and containment of every block that holds ``threshold`` of a template's words."""
    if any(len(words_of(t)) > size - stride for t in templates.values()):
        raise ValueError("a template is longer than the overlap of two blocks")
    blocks = docs.select(
        *keys, F.explode(let(alnum_words(F.col(text)), lambda w: _blocks(w, size, stride))).alias("block")
    )
    vocabulary = sorted({w for t in templates.values() for w in words_of(t)})
    order = rarity_order(blocks, vocabulary)
    rows = prefix_rows(templates, order, threshold)
    prefixes = spark.createDataFrame(
        rows, "word string, label string, place int, size int, need int, template array<string>"
    )
    # The block's words in the global order; words of no template count for nothing.
    ordered = F.array_intersect(F.array(*map(F.lit, order)), F.col("block"))
    heads = F.array(*map(F.lit, sorted({r[0] for r in rows})))
    shortest = min(r[4] for r in rows)
    candidates = (
        blocks.select(*keys, ordered.alias("ordered"))
        .filter(F.size("ordered") >= shortest)
        .select(*keys, "ordered", F.explode(F.array_intersect("ordered", heads)).alias("word"))
        # One row per prefix word of the templates: bounded by the parameter.
        .join(F.broadcast(prefixes), "word")
    )
    at = F.array_position("ordered", F.col("word")).cast("int") - 1
    # Everything from the shared word on, plus at most what stands before it on the shorter side.
    bound = F.least(F.col("place"), at) + F.least(F.col("size") - F.col("place"), F.size("ordered") - at)
    overlap = F.size(F.array_intersect("template", "ordered"))
    return (
        candidates.filter((F.size("ordered") >= F.col("need")) & (bound >= F.col("need")))
        .withColumn("overlap", overlap)
        .filter(F.col("overlap") >= F.col("need"))
        .select(*keys, "label", (F.col("overlap") / F.col("size")).alias("containment"))
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = 0.8,
    size: int = 256,
    stride: int = 128,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are ignored) with its licences.

    ``n_words``; ``n_base`` places where a phrase stands; ``first_word`` and ``last_word``, the smallest
    and largest of them (null without any); ``base_labels``; ``labels``, with those of the similar
    blocks; ``score``: 1 with a phrase, else the highest containment of a template, else 0.

    Null and empty texts have no words, no labels and score 0. Rows that share id and text get equal
    results; rows that share an id only are told apart by their texts. A null id is an id. An empty
    table gives no rows. Labels are sorted, so ties have no influence.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", row_hash(F.col("text")).alias("text_hash"), "text")
    found = (
        similar_blocks(spark, rows, templates, threshold, size, stride, keys=("doc_id", "text_hash"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("label").alias("similar"), F.max("containment").alias("best"))
        .select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "similar", "best")
    )

    def base(words: Column) -> Column:
        places = [(_places(words, words_of(p)), label) for p, label in phrases.items()]
        return F.struct(F.size(words).cast("long").alias("n"), *(p.alias(f"p{i}") for i, (p, _) in enumerate(places)))

    labels = list(phrases.values())
    every = F.flatten(F.array(*(F.col(f"b.p{i}") for i in range(len(labels)))))
    own = F.array_compact(
        F.array(*(F.when(F.size(f"b.p{i}") > 0, F.lit(label)) for i, label in enumerate(labels)))
    )
    direct = rows.select("doc_id", "text_hash", let(alnum_words(F.col("text")), base).alias("b")).select(
        "doc_id",
        "text_hash",
        F.col("b.n").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        own.alias("own"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    both = F.array_union("own", F.coalesce("similar", F.array().cast("array<string>")))
    return direct.join(found, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("own")), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
