"""License notices by an exact set-similarity join between blocks of text and templates.

A block is a window of consecutive words, a template the set of words of a known notice. Words are put in one global
order, the rarest of the corpus first. If a block holds enough of a template's words, one of the block's first words in
that order is one of the template's first ones (prefix filter), the block has enough words at all (length filter), and
behind the shared word both have enough words left (positional filter). What passes all three is compared exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored, text_or_empty

# Phrases whose places are counted, with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Wording of well-known public notices, with the labels of the licenses.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Percent of a template's different words that a block must hold.
CONTAINMENT = 80

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: What ends a word, capitals not yet lowered.
NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Characters of a text whose words are in memory at once, but for a longer word.
CHUNK = 1 << 16


def words_of(text: str) -> Iterator[list[str]]:
    """The words of the whole text, in lists of a chunk each."""
    start = 0
    while start < len(text):
        end = NO_WORD.search(text, start + CHUNK) if start + CHUNK < len(text) else None
        stop = end.start() if end else len(text)
        yield WORD.findall(text[start:stop].encode().lower().decode())  # of bytes, lower() changes A-Z only
        start = stop


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: Words that a block must hold; half a block's length: a notice of so many words lies in one block as a whole.
    least: int
    stride: int


def prepare(templates: tuple[tuple[str, str], ...], containment: int) -> list[Template]:
    """Templates with their different words; those without words are left out."""
    out = []
    for label, text in templates:
        words = [w for chunk in words_of(text) for w in chunk]
        if words:
            distinct = tuple(dict.fromkeys(words))
            least = max(1, -(-containment * len(distinct) // 100))
            out.append(Template(label, distinct, least, 1 << (len(words) - 1).bit_length()))
    return out


SCANNED = ("uid long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
           "words array<int>, blocks array<struct<stride: int, block: long, words: array<int>>>")


def _scan(ids: dict[str, int], phrases: dict[tuple[int, ...], str], least: dict[int, int]):
    """For every text: its words that templates use, the places of the phrases, and the blocks that hold at least as
    many different template words as the least demanding template of their length asks for."""
    firsts: dict[int, list[tuple[tuple[int, ...], str]]] = {}
    for phrase, label in phrases.items():
        firsts.setdefault(phrase[0], []).append((phrase, label))

    def measure(text: str) -> tuple:
        n, at, known = 0, [], []
        for chunk in words_of(text):
            for k, word in enumerate(chunk, n):
                if (i := ids.get(word)) is not None:
                    at.append(k)
                    known.append(i)
            n += len(chunk)
        places, labels = [], set()
        for k, i in enumerate(known):
            for phrase, label in firsts.get(i, ()):
                m = len(phrase)
                if tuple(known[k:k + m]) == phrase and at[k + m - 1] - at[k] == m - 1:
                    places.append(at[k])
                    labels.add(label)
        blocks, different = [], len(set(known))
        for stride, enough in least.items():
            if different < enough:
                continue
            halves: dict[int, set[int]] = {}
            for k, i in zip(at, known, strict=True):
                halves.setdefault(k // stride, set()).add(i)
            # Block k is made of the halves k and k + 1.
            for k in sorted(halves.keys() | {h - 1 for h in halves if h}):
                found = halves.get(k, set()) | halves.get(k + 1, set())
                if len(found) >= enough:
                    blocks.append({"stride": stride, "block": k, "words": sorted(found)})
        return (n, len(places), min(places, default=None), max(places, default=None), sorted(labels), known, blocks)

    names = [c.split()[0] for c in SCANNED.split(", ")[2:8]] + ["blocks"]
    block = pa.struct([("stride", pa.int32()), ("block", pa.int64()), ("words", pa.list_(pa.int32()))])
    kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(block)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(measure(t.as_py()) for t in batch["text"]), strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch["uid"], batch["doc_id"], *(pa.array(c, k) for c, k in zip(found, kinds, strict=True))],
                ["uid", "doc_id", *names])

    return run


def scan(docs: DataFrame, templates: list[Template], phrases: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """The scanned texts, written, and the words by number. One pass over the texts, no shuffle."""
    split = {tuple(w for chunk in words_of(phrase) for w in chunk): label for phrase, label in phrases.items()}
    words = list(dict.fromkeys([*(w for t in templates for w in t.words), *(w for phrase in split for w in phrase)]))
    ids = {w: k for k, w in enumerate(words)}
    least = {s: min(t.least for t in templates if t.stride == s) for s in sorted({t.stride for t in templates})}
    numbered = {tuple(ids[w] for w in phrase): label for phrase, label in split.items() if phrase}
    source = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                         text_or_empty().alias("text"))
    return stored(source.mapInArrow(_scan(ids, numbered, least), SCANNED), "licenses-scanned"), words


def global_order(scanned: DataFrame, words: list[str]) -> list[int]:
    """Each word's place in the order of their counts in the whole corpus, rarest first; one count per word of a
    template comes to the driver."""
    counts = dict(scanned.select(F.explode("words").alias("w")).groupBy("w").count().collect())
    ranked = sorted(range(len(words)), key=lambda k: (counts.get(k, 0), k))
    place = [0] * len(words)
    for rank, k in enumerate(ranked):
        place[k] = rank
    return place


def join_blocks(scanned: DataFrame, words: list[str], templates: list[Template]) -> DataFrame:
    """uid, doc_id, template, label, first_word, words, containment: every block that holds enough of a template.

    The templates are the driver's, so their index is a small local table. A pair is kept at its first shared word only,
    so it comes once without a shuffle. Exact: no pair that meets the threshold is missed, and none below it is kept.
    """
    spark = scanned.sparkSession
    place = global_order(scanned, words)
    ids = {w: k for k, w in enumerate(words)}
    index = []
    for number, t in enumerate(templates):
        ordered = sorted(place[ids[w]] for w in t.words)
        index += [(w, t.stride, number, t.label, i, t.least, ordered)
                  for i, w in enumerate(ordered[:len(ordered) - t.least + 1])]
    prefixes = spark.createDataFrame(index, "word int, stride int, template int, label string, i int, least int, "
                                            "pattern array<int>")
    least = F.create_map(*(F.lit(x) for s in sorted({t.stride for t in templates})
                           for x in (s, min(t.least for t in templates if t.stride == s))))
    blocks = scanned.where(F.size("blocks") > 0).select("uid", "doc_id", F.explode("blocks").alias("b"))
    blocks = blocks.select("uid", "doc_id", "b.stride", "b.block", F.array_sort(
        F.transform("b.words", lambda w: F.element_at(F.lit(place), w + 1))).alias("have"))
    # No template of this length asks for more than the block's first words, so a pair shares one of these.
    first = blocks.withColumn("prefix", F.slice("have", F.lit(1), F.size("have") - F.element_at(least, F.col("stride")) + 1))
    met = first.select("uid", "doc_id", "stride", "block", "have", F.posexplode("prefix").alias("j", "word"))
    met = met.join(prefixes, ["word", "stride"])
    room = 1 + F.least(F.size("pattern") - F.col("i") - 1, F.size("have") - F.col("j") - 1)
    met = met.where((F.size("have") >= F.col("least")) & (room >= F.col("least")))
    shared = F.array_intersect("have", "pattern")
    met = met.withColumn("shared", shared).where((F.size("shared") >= F.col("least")) & (F.col("shared")[0] == F.col("word")))
    return met.select("uid", "doc_id", "template", "label", (F.col("block") * F.col("stride")).alias("first_word"),
                      (2 * F.col("stride")).cast("long").alias("words"),
                      (F.size("shared") / F.size("pattern")).alias("containment"))


def license_blocks(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                   containment: int = CONTAINMENT) -> DataFrame:
    """Every block of every text that holds ``containment`` percent of a template's different words.

    Columns as in :func:`join_blocks`; ``first_word`` counts words from 0, ``words`` is the block's length (a text may end
    before it). Edge cases as in :func:`license_report`.
    """
    prepared = prepare(templates, containment)
    scanned, words = scan(docs, prepared, {})
    return join_blocks(scanned, words, prepared)


def license_report(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                   containment: int = CONTAINMENT, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``.

    ``score`` is 1 where a phrase stands, else the largest containment found, else 0. A null or empty text has no words,
    no labels and score 0. Texts are read whole, a chunk of words at a time. Repeated rows, equal ids and null ids are
    rows of their own; further columns are not read; an empty table gives no rows.
    """
    prepared = prepare(templates, containment)
    scanned, words = scan(docs, prepared, phrases)
    found = (join_blocks(scanned, words, prepared).groupBy("uid")
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")))
    joined = scanned.join(found, "uid", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
