"""License scans by diagonal voting.

All rolling k-grams of a text's words are joined, by hash, with the places of the templates'
k-grams (and compared word by word, so a hash collision is no hit). A hit at word i of place
j votes for the diagonal i - j: a copy of a template puts its hits on one diagonal, an
inserted or missing word moves the rest to a neighbouring one. Votes are summed by (text,
template, diagonal), neighbouring diagonals are merged, and a merged span is verified by
its similarity: the template's words that its hits cover, over the longer of template and
span. A span's best single diagonal counts if it fares better than the merged span.

Templates of fewer than ``EXACT_BELOW`` words must match wholly, others to ``LEAST``. The
templates are a parameter and few: their k-grams are broadcast, the only data that is.
Everything is DataFrame functions. The text is read and split once; what goes on to the
shuffles is one slim row a text and one a hit. A group (text, template) is a part of one row.

Null text is the empty text (no words, no spans). Repeated rows each get their result.
Result columns take a free name where the input has theirs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from toxiscope.llm.common import UPPER, ascii_lower, free_name, spread_rows, stored

#: Words of the contract: not ASCII, or a digit or lower-case letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = str.maketrans(UPPER, UPPER.lower())
GRAM = 3
LEAST = 0.8
EXACT_BELOW = 10
#: Neighbouring diagonals are at most this share of the template's words apart.
SHIFT = 0.125


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False  # a phrase whose exact places are reported as such


# The phrases of the contract, and opening words of public license notices.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the Software), to deal in the Software without restriction, "
             "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
             "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
             "except in compliance with the License. You may obtain a copy of the License at"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
             "all copies"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
             "published by the Free Software Foundation"),
    Template("gpl-2", "GNU General Public License version 2"),
    Template("gpl-3", "GNU General Public License version 3"),
    Template("mpl-2", "subject to the terms of the Mozilla Public License v 2 0 If a copy of the MPL was not "
             "distributed with this file You can obtain one at"),
    Template("cc-by-nc", "Creative Commons Attribution NonCommercial"),
    Template("cc-by-sa", "Creative Commons Attribution ShareAlike"),
)
TEMPLATES = PHRASES + NOTICES


def split_words(text: Column) -> Column:
    """The words of a text, upper-case ASCII letters lowered; null is the empty text."""
    # only the first and the last part can be empty
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _hash(words: Column, at: Column, gram: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(gram)])


def _template_grams(spark, templates: tuple[Template, ...], gram: int) -> tuple[DataFrame, DataFrame]:
    """Places of all k-grams, and one row a template."""
    worded = [[w for w in re.split(NOT_WORD, t.text.translate(_LOWER)) if w] for t in templates]
    if any(len(words) < gram for words in worded):
        raise ValueError(f"a template has fewer than {gram} words")
    rows = [
        F.struct(
            F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            F.array(*[F.lit(w) for w in words]).alias("words"),
        ) for i, (t, words) in enumerate(zip(templates, worded))
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    info = table.select("template", "label", "base", F.size("words").alias("size"))
    places = table.select("template", "words", F.explode(F.sequence(F.lit(0), F.size("words") - gram)).alias("place"))
    return places.select(
        "template", "place", F.slice("words", F.col("place") + 1, gram).alias("gram"), _hash(F.col("words"), F.col("place"), gram).alias("key")
    ), info


def _covered(places: Column, gram: int) -> Column:
    """Template words that k-grams at these (distinct) places cover."""
    sorted_places = F.array_sort(places)
    steps = F.zip_with(F.slice(sorted_places, 2, F.size(places)), sorted_places, lambda b, a: F.least(b - a, F.lit(gram)))
    # the last pair has no next place and counts a whole k-gram
    return F.aggregate(steps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(gram)))


def gram_hits(docs: DataFrame, text: str, keep: list[str], places: DataFrame, gram: int) -> DataFrame:
    """One row a text (``at`` = -1, with its ``kept`` columns and ``n_words``) and one a hit."""
    worded = spread_rows(docs).select(
        F.monotonically_increasing_id().alias("uid"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        split_words(F.col(f"`{text}`")).alias("words"),
    )
    grams = worded.select(
        "uid", "kept", "words", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - gram, F.lit(-1)))).alias("at")
    ).withColumn("key", F.when(F.col("at") >= 0, _hash(F.col("words"), F.col("at"), gram)))
    hit = F.col("template").isNotNull()
    for i in range(gram):
        hit &= F.get("words", F.col("at") + i) == F.get("gram", F.lit(i))
    return grams.join(F.broadcast(places), "key", "left").where((F.col("at") < 0) | hit).select(
        "uid", "at", "template", "place", F.when(F.col("at") < 0, F.col("kept")).alias("kept"),
        F.when(F.col("at") < 0, F.size("words").cast("long")).alias("n_words"),
    )


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    gram: int = GRAM,
    least: float = LEAST,
    n_words: str = "n_words",
    spans: str = "spans",
) -> DataFrame:
    """``docs`` without its text, with ``n_words`` and ``spans``: an array of (label, base,
    start, length, similarity) of all verified spans, by start, length and label."""
    keep = [c for c in docs.columns if c != text]
    places, info = _template_grams(docs.sparkSession, templates, gram)
    rows = stored(gram_hits(docs, text, keep, places, gram), "license-hits")
    info = F.broadcast(info)

    diagonals = rows.where("at >= 0").groupBy("uid", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.collect_list("place").alias("places")
    ).join(info, "template")
    span = lambda: F.col("last") + gram - F.col("first")
    share = lambda: _covered(F.col("places"), gram) / F.greatest(F.col("size"), span())
    by = Window.partitionBy("uid", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > F.floor(F.col("size") * SHIFT)
    alone = diagonals.withColumn("similarity", share())
    merged = (
        alone.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("part", F.sum("new").over(by))
        .groupBy("uid", "template", "part", "label", "base", "size").agg(
            F.max(F.struct("similarity", -F.col("first"), "last")).alias("best"),
            F.min("first").alias("first"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        ).withColumn("similarity", share())
    )
    better = F.col("best.similarity") >= F.col("similarity")
    first = F.when(better, -F.col("best.col2")).otherwise(F.col("first"))
    last = F.when(better, F.col("best.last")).otherwise(F.col("last"))
    notices = merged.where(~F.col("base")).select(
        "uid", "size", _span(F.col("label"), F.lit(False), first, last + gram - first, F.greatest("best.similarity", "similarity"))
    )
    # an exact phrase is a diagonal with all of its k-grams; each place is one
    exact = alone.where(F.col("base") & (F.size("places") == F.col("size") - gram + 1)).select(
        "uid", "size", _span(F.col("label"), F.lit(True), F.col("first"), F.col("size"), F.lit(1.0))
    )
    needed = F.when(F.col("size") < EXACT_BELOW, F.lit(1.0)).otherwise(F.lit(least))
    found = exact.unionByName(notices.where(F.col("span.similarity") >= needed)).groupBy("uid").agg(
        F.array_sort(F.collect_list("span")).alias("spans")
    )
    texts = rows.where("at < 0").select("uid", "kept", "n_words")
    kind = found.schema["spans"].dataType
    out = texts.join(found, "uid", "left").select(
        *[F.col("kept").getField(c).alias(c) for c in keep], F.col("n_words").alias(free_name(docs, n_words)),
        _ordered(F.coalesce("spans", F.array().cast(kind))).alias(free_name(docs, spans)),
    )
    return out


def _span(label: Column, base: Column, start: Column, length: Column, similarity: Column) -> Column:
    return F.struct(
        start.cast(T.LongType()).alias("start"), length.cast(T.LongType()).alias("length"), label.alias("label"),
        base.alias("base"), similarity.cast("double").alias("similarity"),
    ).alias("span")


def _ordered(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["label"].alias("label"), s["base"].alias("base"), s["start"].alias("start"),
                                                  s["length"].alias("length"), s["similarity"].alias("similarity")))
