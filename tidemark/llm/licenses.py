"""Licence notices, found by an exact set-similarity join with templates.

A template is a set of words, and so is a block of a text: blocks of
``block_words(template)`` words start every half of that, so a notice as long as its
template stands whole in one of them. A block meets a template if it has at least
``THRESHOLD`` of the template's words (containment); all such pairs are found:

* The words of all templates are put into one order, rarest in the corpus first.
* Prefix filter: of ``m`` words ``c`` must be shared, so one of the template's first
  ``m - c + 1`` words is; blocks are joined with templates on these words only, and
  texts without any of them are not cut into blocks at all.
* Length filter: blocks with fewer than ``c`` words of templates of their length go.
* Positional filter: the first shared word must leave ``c`` words on both sides.

Survivors are compared word by word. Only the templates, which are a parameter, are
broadcast; one count for each of their words reaches the driver.

Beside the join, fixed phrases are counted where their words stand side by side.

Defined results: a NULL text is an empty text, which has no words and score 0; rows
with the same identifier and text have the same result, each its own row; NULL
identifiers are kept; an empty table gives no rows. Other columns are not read by
``license_labels`` and pass unchanged through ``with_licenses``, whatever they are
named, unless their name is one of the added ones: that column is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored, text_of

THRESHOLD = 0.9

#: What separates words, and the phrases that are counted.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label and notice. Well-known short notices, and the first paragraphs
#: of longer ones.
TEMPLATES: dict[str, tuple[str, str]] = {
    "mit_line": ("mit", "Released under the MIT License."),
    "apache_line": ("apache", "Licensed under the Apache License, Version 2.0."),
    "gpl_line": ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    "cc_by_nc_line": ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    "cc_by_line": ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "mit_grant": (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "apache_notice": (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS"
        " OF ANY KIND, either express or implied.",
    ),
    "gpl_notice": (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    "bsd_terms": (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer.",
    ),
}

Templates = Mapping[str, tuple[str, str]]
ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def plain_words(text: str) -> list[str]:
    """Words of a notice, as ``words_of`` finds them in a column."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(SEPARATORS, lower) if w]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def least_shared(size: int, threshold: float = THRESHOLD) -> int:
    """Words that a block must share with a template of ``size`` different ones."""
    return max(1, math.ceil(size * threshold - 1e-9))


def block_words(n_words: int) -> int:
    """Length of the blocks for a template of ``n_words`` words: the power of two
    that is at least twice as long."""
    return 2 << max(3, math.ceil(math.log2(max(1, n_words))))


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _vocabulary(templates: Templates) -> list[str]:
    return sorted({w for _, text in templates.values() for w in plain_words(text)})


def rarest_first(words: DataFrame, templates: Templates = TEMPLATES) -> list[str]:
    """The words of all templates by the number of texts that have them (then by
    themselves). One row for each word comes back."""
    known = _vocabulary(templates)
    found = words.select(F.explode(F.array_intersect(_strings(known), "words")).alias("word"))
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def _template_rows(order: list[str], templates: Templates, threshold: float) -> list[tuple]:
    """length, name, label, words in order, size, least."""
    place = {w: i for i, w in enumerate(order)}
    out = []
    for name, (label, text) in templates.items():
        words = plain_words(text)
        own = sorted(set(words), key=place.__getitem__)
        out.append((block_words(len(words)), name, label, own, len(own), least_shared(len(own), threshold)))
    return out


def _blocks(words: Column, rows: list[tuple], order: list[str]) -> Column:
    """Blocks of each length: start and the words that templates of this length
    have, in order."""

    def of_length(length: int, known: list[str], least: int) -> Column:
        half, n = length // 2, F.size(words)
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), n - half - 1), F.lit(half))

        def block(start: Column) -> Column:
            own = F.array_intersect(_strings(known), F.slice(words, start + 1, F.lit(length)))
            return F.struct(F.lit(length).alias("length"), start.alias("start"), own.alias("shared"))

        return F.filter(F.transform(starts, block), lambda b: F.size(b["shared"]) >= least)

    found = []
    for length in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == length]
        known = {w for r in mine for w in r[3]}
        found.append(of_length(length, [w for w in order if w in known], min(r[5] for r in mine)))
    return F.concat(*found)


def license_blocks(candidates: DataFrame, order: list[str], templates: Templates, threshold: float) -> DataFrame:
    """All pairs of a block and a template with enough words in common: the columns
    of ``candidates`` but ``words``, start and length of the block, name, label,
    shared (how many words), containment."""
    rows = _template_rows(order, templates, threshold)
    keys = [c for c in candidates.columns if c != "words"]
    blocks = candidates.select(*keys, F.explode(_blocks(F.col("words"), rows, order)).alias("block"))
    spread = blocks.select("*", F.posexplode("block.shared").alias("at", "word"))
    prefixes = [(r[0], r[1], r[2], r[3], r[4], r[5], i, w) for r in rows for i, w in enumerate(r[3][: r[4] - r[5] + 1])]
    schema = "length int, name string, label string, own array<string>, size int, least int, place int, word string"
    known = candidates.sparkSession.createDataFrame(prefixes, schema).withColumnsRenamed({"length": "t_length", "word": "t_word"})
    # Bounded by the templates, a parameter: one row for each word of a prefix.
    pairs = spread.join(F.broadcast(known), (F.col("block.length") == F.col("t_length")) & (F.col("word") == F.col("t_word")))
    room = F.least(F.size("block.shared") - F.col("at"), F.col("size") - F.col("place")) >= F.col("least")
    both = pairs.filter(room).withColumn("both", F.array_intersect("block.shared", "own"))
    # A pair meets at each word that it shares; it counts at the first one.
    met = both.filter((F.get("both", F.lit(0)) == F.col("word")) & (F.size("both") >= F.col("least")))
    return met.select(
        *keys,
        F.col("block.start").cast("long").alias("start"),
        F.col("block.length").alias("length"),
        "name",
        "label",
        F.size("both").alias("shared"),
        (F.size("both") / F.col("size")).alias("containment"),
    )


def _phrase_places(words: Column, phrases: Mapping[str, str]) -> Column:
    """Where a phrase starts. Only texts that have one are walked word by word."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    has = reduce(or_, [F.contains(joined, F.lit(f" {p} ")) for p in phrases])

    def starts(i: Column) -> Column:
        spelled = [p.split(" ") for p in phrases]
        return reduce(or_, [reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(p)]) for p in spelled])

    every = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(has, F.filter(every, starts)).otherwise(F.array().cast("array<int>"))


def _phrase_labels(words: Column, phrases: Mapping[str, str]) -> Column:
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    found = [F.when(F.contains(joined, F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()]
    return F.array_distinct(F.array_compact(F.array(*found)))


def _scanned(documents: DataFrame, templates: Templates, threshold: float, phrases: Mapping[str, str]):
    """Phrases of each row, with the words of those texts that have a rare word of a
    template; and the order of words."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = rarest_first(rows.select(words_of(F.col("text")).alias("words")), templates)
    prefix = {w for r in _template_rows(order, templates, threshold) for w in r[3][: r[4] - r[5] + 1]}
    words = rows.select("doc_id", F.sha2("text", 256).alias("text_key"), words_of(F.col("text")).alias("words"))
    may_meet = F.arrays_overlap("words", _strings(sorted(prefix)))
    return (
        stored(
            words.select(
                "doc_id",
                "text_key",
                F.size("words").cast("long").alias("n_words"),
                _phrase_places(F.col("words"), phrases).alias("places"),
                _phrase_labels(F.col("words"), phrases).alias("base"),
                F.when(may_meet, F.col("words")).alias("words"),
            ),
            "license-words",
        ),
        order,
    )


def license_matches(documents: DataFrame, templates: Templates = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key (SHA-256 of the text), start and length (words) of every block
    that meets a template; name, label, shared, containment."""
    scanned, order = _scanned(documents, templates, threshold, PHRASES)
    candidates = scanned.filter("words IS NOT NULL").select("doc_id", "text_key", "words")
    return license_blocks(candidates, order, templates, threshold)


def license_labels(
    documents: DataFrame,
    templates: Templates = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """A row for each document: doc_id, text_key, n_words, n_base (places of phrases),
    first_word and last_word (the smallest and the largest), base_labels, labels (also
    those of templates), score: 1 with a phrase, else the best containment, else 0."""
    scanned, order = _scanned(documents, templates, threshold, phrases)
    candidates = scanned.filter("words IS NOT NULL").select("doc_id", "text_key", "words")
    met = license_blocks(candidates, order, templates, threshold).groupBy("doc_id", "text_key")
    met = met.agg(F.collect_set("label").alias("met"), F.max("containment").alias("best"))
    met = met.withColumnsRenamed({"doc_id": "met_id", "text_key": "met_key"})
    same = F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("text_key") == F.col("met_key"))
    both = scanned.drop("words").join(met, same, "left")
    labels = F.array_union("base", F.coalesce("met", F.array().cast("array<string>")))
    return both.select(
        "doc_id",
        "text_key",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(labels), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def with_licenses(documents: DataFrame, templates: Templates = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, and the columns ``ADDED``."""
    found = license_labels(documents, templates, threshold).dropDuplicates(["doc_id", "text_key"])
    kept = [c for c in documents.columns if c not in ADDED]
    left = documents.select(
        F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(text_of(), 256).alias("key")
    )
    right = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), F.struct(*ADDED).alias("found"))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    return left.join(right, same, "left").select("row.*", "found.*")
