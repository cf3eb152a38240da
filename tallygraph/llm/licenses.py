"""License scans: phrases at their places, and an exact set-similarity join with license notices.

A text's blocks are its lines and its paragraphs of several lines. A block matches a notice if it
contains enough of the notice's distinct words. The words are put in order of their frequency over
all blocks, rarest first. A block that reaches the threshold shares one of the notice's rarest
words, its prefix, and shares it early enough in both orders for the rest to suffice; it also
has enough words at all. Blocks that pass these three filters are compared in full.

Only DataFrame functions are used.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.text import split_lines
from tallygraph.staging import Staging

# A word, the phrases looked for at their places, and public license notices.
# The class names what a word has, as matching what it does not have takes Java several times as long.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
PHRASES = {"apache": "apache license", "gpl": "general public license", "mit": "mit license"}
NOTICES = (
    ("agpl", "licensed under the GNU Affero General Public License version 3"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("bsd", "Use of this source code is governed by a BSD-style license"),
    ("bsd", "Released under the BSD License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class LicenseParams:
    """``percent`` of a notice's distinct words must stand in a block. ``notices`` are pairs of a
    label and a text, and ``phrases`` a phrase for each base label; both must be short lists, as
    their words travel with the plan."""

    percent: int = 85
    notices: tuple = NOTICES
    phrases: dict = field(default_factory=lambda: dict(PHRASES))


def needed(size: int, percent: int) -> int:
    """How many of so many distinct words reach the threshold."""
    return -(-size * percent // 100)


def notice_words(text: str) -> list[str]:
    """The distinct words of a notice, in order of the alphabet."""
    return sorted(set("".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text).split()))


def _word_lists(text: Column) -> Column:
    """The words of each line.

    Words are only counted and compared with ASCII ones, so all letters may be lower-cased, which is
    far cheaper than A-Z alone. The Kelvin sign would become an ASCII letter and is put out of the way.
    """
    lowered = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u212b")))
    return F.transform(split_lines(lowered), lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))


def _places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other, counted from 0. The places are tried
    only in texts that have its longest word."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == part)
        return hit

    some = F.array_contains(words, max(parts, key=len)) & (F.size(words) >= len(parts))
    return F.when(some, F.filter(starts, here)).otherwise(F.array().cast("array<int>"))


def _paragraphs(lists: Column) -> Column:
    """The words of each run of two or more lines with words; a line without ends a run."""
    n = F.size(lists)
    breaks = F.filter(F.sequence(F.lit(0), n + 1), lambda i: (i == 0) | (i == n + 1) | (F.size(F.get(lists, i - 1)) == 0))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(breaks) - 1),
        lambda k: F.struct(
            (F.get(breaks, k - 1) + 1).alias("first"), (F.get(breaks, k) - F.get(breaks, k - 1) - 1).alias("size")
        ),
    )
    long = F.filter(runs, lambda r: r["size"] > 1)
    return F.transform(long, lambda r: F.flatten(F.slice(lists, r["first"], r["size"])))


def _scanned(docs: DataFrame, notices: list[tuple[str, list[str], int]], params: LicenseParams) -> DataFrame:
    """Each row under a number of its own, with its base places and its blocks, of which only the
    words of notices are kept. Blocks with too few of them for any notice are left out."""
    vocabulary = sorted({w for _, words, _ in notices for w in words})
    least = min((need for _, _, need in notices), default=1)
    lists = docs.select("doc_id", _word_lists(F.col("text")).alias("lists"))
    places = {label: _places(F.col("words"), phrase).alias(label) for label, phrase in params.phrases.items()}

    def known(words: Column) -> Column:
        return F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary)))

    blocks = F.transform(F.concat(F.col("lists"), _paragraphs(F.col("lists"))), known)
    found = lists.select(
        "doc_id",
        F.flatten("lists").alias("words"),
        F.filter(blocks, lambda b: F.size(b) >= least).alias("blocks"),
    ).select("doc_id", F.size("words").cast("long").alias("n_words"), "blocks", F.struct(*places.values()).alias("places"))
    every = F.concat(*[F.col("places")[label] for label in params.phrases])
    labels = F.filter(
        F.array(*[F.when(F.size(F.col("places")[label]) > 0, F.lit(label)) for label in params.phrases]), F.isnotnull
    )
    return found.select(
        F.monotonically_increasing_id().alias("row_no"),
        "doc_id",
        "n_words",
        "blocks",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(labels).alias("base_labels"),
    )


def _matches(scanned: DataFrame, notices: list[tuple[str, list[str], int]]) -> DataFrame:
    """``row_no, label, containment`` for each pair of a block and a notice that reaches the threshold."""
    spark = scanned.sparkSession
    counts = scanned.select(F.explode(F.flatten("blocks")).alias("word")).groupBy("word").count()
    # One row per word of the notices at most.
    frequency = {row["word"]: row["count"] for row in counts.collect()}
    order = sorted({w for _, words, _ in notices for w in words}, key=lambda w: (frequency.get(w, 0), w))
    index = []
    for label, words, need in notices:
        own = [w for w in order if w in set(words)]
        index += [(w, i, label, need, own) for i, w in enumerate(own[: len(own) - need + 1])]
    rarest = sorted({row[0] for row in index})
    prefixes = spark.createDataFrame(index, "word string, i int, label string, need int, own array<string>")

    likely = F.filter("blocks", lambda b: F.exists(b, lambda w: w.isin(rarest)))
    every = F.array(*[F.lit(w) for w in order]).cast("array<string>")
    ordered = scanned.select("row_no", F.explode(likely).alias("block")).select(
        "row_no", F.array_intersect(every, F.col("block")).alias("block")
    )
    placed = ordered.select("row_no", "block", F.posexplode("block").alias("j", "word"))
    size, total = F.size("block"), F.size("own")
    # What may be shared from here on: this word and the rest of the shorter remainder.
    reachable = F.lit(1) + F.least(total - F.col("i") - 1, size - F.col("j") - 1)
    met = placed.join(F.broadcast(prefixes), "word").where((size >= F.col("need")) & (reachable >= F.col("need")))
    shared = F.size(F.array_intersect("own", "block"))
    return met.where(shared >= F.col("need")).select("row_no", "label", (shared / total).alias("containment"))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: LicenseParams = LicenseParams()
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``; the labels are sorted arrays.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the first and
    the last of them, null without any. ``labels`` has the base labels and those of the notices that
    one of the text's blocks contains; ``score`` is the largest share of a notice that one of them
    contains, 0 if none reaches the threshold. A null text is an empty one, without words. Texts of any length are
    scanned whole, a long line or paragraph being one block. Rows that repeat an id are scanned
    one by one; a null id stays null; other columns are ignored; an empty table gives an empty
    result. Equal notices, or several of one label, give the label once.

    The texts are read once; their blocks, cut down to the words of notices, are a small table in
    ``spark.checkpoint.dir`` that the result reads. A notice that most documents carry moves no
    rows: the notices are broadcast, and their number does not depend on the data.
    """
    notices = [(label, words, needed(len(words), params.percent)) for label, text in params.notices if (words := notice_words(text))]
    area = Staging(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scanned = area.table(_scanned(plain, notices, params), "scanned")
    found = _matches(scanned, notices).groupBy("row_no").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("score")
    )
    none = F.array().cast("array<string>")
    return scanned.drop("blocks").join(found, "row_no", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("found", none)))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
