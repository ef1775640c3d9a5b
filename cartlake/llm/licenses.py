"""License scan: MinHash bands over overlapping word windows, then exact shingle containment.

Templates are grouped by length. A text is cut into windows of one and a half times the
longest template of a group, so far apart that any stretch of a template's length lies whole
in one of them. A window that holds 80 % of a template's shingles has a Jaccard similarity of
0.47 or more with it; with 24 bands of one value such a pair meets in a band with a chance
above 0.999999. Every match is then verified by exact containment.

Only windows that can match are hashed: each template gets guard words, chosen so that its
shingles without a guard word make up less than the asked containment. A matching window thus
holds one, wherever it lies. All steps are built-in functions.

Words are runs of a-z and 0-9 after lower-casing; shingles have five words, or as many as the
template if it is shorter. The registered query knows the notices in `TEMPLATES` only, none of
LGPL, AGPL, ISC, BSD-2-Clause or GPL-2.0 and no whole license text. Results for odd input: null, empty and wordless texts match nothing,
and neither do null or wordless templates. Rows that repeat a doc_id count as one document whose texts are all searched,
templates that repeat a license_id as alternatives. Several matches of one license give one row
for the best, ties the first. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlake.llm.common import bounded, land

SHINGLE = 5
PERCENT = 80
BANDS = 24
MOST_TEMPLATES = 5_000

# Notices by which licenses are declared, and the opening of their texts.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license_id string, text string")


def words_of(text: str | None) -> list[str]:
    return re.findall("[a-z0-9]+", (text or "").lower())


def guard_words(words: list[str], percent: int = PERCENT) -> set[str]:
    """The longest words such that shingles without them are less than `percent` of all."""
    k = min(SHINGLE, len(words))
    left = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    total, guards = len(left), set()
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if 100 * len(left) < percent * total:
            break
        if any(word in s for s in left):
            guards.add(word)
            left = {s for s in left if word not in s}
    return guards


def _groups(templates: list[tuple[str, str]], percent: int):
    """(shingle words, longest template, guards, [(number, license, words)]) by length."""
    groups: dict[tuple[int, int], list] = {}
    for number, (name, text) in enumerate(templates):
        words = words_of(text)
        if words and name is not None:
            longest = len(words) if len(words) <= SHINGLE else math.ceil(1.4 ** math.ceil(math.log(len(words), 1.4)))
            groups.setdefault((min(SHINGLE, len(words)), longest), []).append((number, name, words))
    for (k, longest), members in sorted(groups.items()):
        guards = set().union(*(guard_words(w, percent) for _, _, w in members))
        yield k, longest, sorted(guards), members


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _shingles(words: str, k: int | str) -> str:
    """SQL for the distinct k-word shingles of an array of at least k words; k is a number or a column."""
    return f"array_distinct(transform(sequence(1, size({words}) - {k} + 1), i -> array_join(slice({words}, i, {k}), ' ')))"


_BAND_VALUES = f"transform(sequence(1, {BANDS}), b -> named_struct('b', b, 'v', array_min(transform(sh, s -> xxhash64(s, b)))))"


def scan(docs: DataFrame, templates: DataFrame | None = None, percent: int = PERCENT) -> DataFrame:
    """(doc_id, license_id, shared, shingles, word): documents with the licenses they hold.

    shared of the template's shingles lie in the window that begins at `word` (from 0).
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = (templates if templates is not None else default_templates(spark)).select("license_id", "text")
    rows = [tuple(r) for r in listed.orderBy("license_id", "text").limit(MOST_TEMPLATES + 1).collect()]
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates; scan in blocks")
    groups = list(_groups(rows, percent))
    none = "doc_id long, license_id string, shared int, shingles int, word int"
    if not groups:
        return spark.createDataFrame([], none)

    every = sorted({g for _, _, guards, _ in groups for g in guards})
    # Ascii-only case folding in the filter would lose words that lower() makes ascii, such as the Kelvin sign.
    maybe = given.where(F.col("text").rlike("(?iu)" + "|".join(every)))
    maybe = maybe.selectExpr("doc_id", "filter(split(lower(text), '[^a-z0-9]+'), w -> w <> '') AS words")
    # Places of guard words of any group; each group looks among these few only, so texts are read and split once.
    maybe = maybe.where("size(words) > 0").selectExpr(
        "doc_id", "words", f"filter(sequence(0, size(words) - 1), p -> words[p] IN ({_quoted(every)})) AS spots"
    )
    windows, listed = [], []
    for g, (k, longest, guards, members) in enumerate(groups):
        width = longest + (longest + 1) // 2
        stride = width - longest + 1
        spots = f"filter(spots, p -> words[p] IN ({_quoted(guards)}))"
        # Windows i * stride .. i * stride + width - 1 that hold a guard word and begin inside the text.
        around = f"sequence(greatest(0, int(ceil((p - {width - 1}) / {stride}))), p div {stride})"
        begins = f"array_distinct(flatten(transform({spots}, p -> transform({around}, i -> int(i * {stride})))))"
        windows.append(f"transform({begins}, i -> named_struct('g', {g}, 'k', {k}, 'width', {width}, 'word', i))")
        listed += [(g, k, n, name, words) for n, name, words in members]
    own = spark.createDataFrame(listed, "g int, k int, number int, license_id string, win array<string>")
    own = own.selectExpr("g", "number", "license_id", f"{_shingles('win', 'k')} AS sh")
    cut = maybe.selectExpr("doc_id", "words", f"inline(concat({', '.join(windows)}))")
    cut = cut.selectExpr("doc_id", "g", "word", "k", "slice(words, word + 1, width) AS win").where("size(win) >= k")
    cut = cut.selectExpr("doc_id", "g", "word", f"{_shingles('win', 'k')} AS sh")
    bands = own.selectExpr("g", "number", f"inline({_BAND_VALUES})")
    hits = cut.selectExpr("doc_id", "g", "word", "sh", f"inline({_BAND_VALUES})")
    hits = hits.join(bounded(bands), ["g", "b", "v"]).select("doc_id", "word", "number", "sh").distinct()
    own = own.select("number", "license_id", F.col("sh").alias("whole"))
    found = hits.join(bounded(own), "number").selectExpr(
        "doc_id", "license_id", "size(array_intersect(sh, whole)) AS shared", "size(whole) AS shingles", "word"
    )
    found = found.where(f"100 * shared >= {percent} * shingles")
    share = F.struct((-F.col("shared") / F.col("shingles")).alias("o"), "word", (-F.col("shingles")).alias("n"), "shared", "shingles")
    best = found.groupBy("doc_id", "license_id").agg(F.min(share).alias("s"))
    return best.select("doc_id", "license_id", "s.shared", "s.shingles", "s.word")


def permissive_only(docs: DataFrame, refused: tuple[str, ...], templates: DataFrame | None = None) -> DataFrame:
    """The rows of docs that declare none of the refused licenses."""
    gone = land(scan(docs, templates).where(F.col("license_id").isin(*refused)).select("doc_id").distinct(), "refused")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]), "left_anti")
