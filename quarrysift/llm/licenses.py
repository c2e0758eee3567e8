"""License scans by diagonal voting, in DataFrame code only.

Hashes of all rolling word k-grams of the documents are joined to those of license templates. A
gram at word p of a document and at word q of a template votes for the diagonal p - q, the place where the
template would begin. Votes are compared word for word and aggregated by diagonal; neighbouring
diagonals are merged, since words put in or left out move the rest of a template to another one; a merged
span counts if enough of the template's words are covered. Phrases are templates that have to
be there as they are: all their grams on one diagonal.

Texts are read and split once and never move. What is stored is a narrow row per document and a row
per gram that some template has. Only hashes of templates' grams are broadcast, in blocks of bounded size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored
from .decontam import word_count, words_of

GRAM = 3
# Diagonals this far apart belong together, or a quarter of the template's words if that is less.
NEAR = 8
# Per cent of a template's words that a span has to cover.
LEAST_COVER = 60
# Hashes broadcast at a time; every further block is one more pass over the texts.
GRAMS_PER_BLOCK = 200_000

# Phrases with their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Notices as licences ask for them, with labels of their own.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def template_table(spark: SparkSession, templates: list[tuple[str, str]], phrases: list[tuple[str, str]]) -> DataFrame:
    """Number (tid), label, exact and text of templates and phrases."""
    given = [(label, text, False) for label, text in templates] + [(label, text, True) for label, text in phrases]
    rows = [
        F.struct(F.lit(n).alias("tid"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.lit(text).alias("text"))
        for n, (label, text, exact) in enumerate(given)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def gram_table(templates: DataFrame, gram: int) -> DataFrame:
    """Per gram of a template: tid, label, exact, its words n, the gram's place q, length m, words gw and hash g."""
    words = templates.select("tid", "label", "exact", F.filter(words_of("text"), lambda w: w != "").alias("ws"))
    words = words.where("size(ws) > 0").withColumn("n", F.size("ws")).withColumn("m", F.least(F.lit(gram), "n"))
    grams = words.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("m"))).alias("q"))
    grams = grams.withColumn("gw", F.slice("ws", F.col("q") + 1, F.col("m"))).drop("ws")
    hashes = [(F.col("m") == m, F.xxhash64(*(F.get("gw", F.lit(j)) for j in range(m)))) for m in range(1, gram + 1)]
    return grams.withColumn("g", reduce(lambda c, x: c.when(*x), hashes[1:], F.when(*hashes[0])))


def shared_grams(docs: DataFrame, grams: DataFrame, gram: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored: a row (k, h, n_words) per document, and its grams that a template has (k, h, p, near).

    ``near`` are the words of the gram; ``p`` counts words from 0.
    """
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("x"))
    rows = rows.select("k", F.xxhash64("x").alias("h"), words_of("x").alias("ws"))
    # Place -1 stands for the document itself, so that one pass gives both kinds of rows.
    places = rows.select("k", "h", "ws", F.explode(F.sequence(F.lit(-1), F.size("ws") - 1)).alias("at"))
    keys = stored(grams.select("m", "g").distinct(), "template-grams")
    sizes = {r["m"]: r["n"] for r in keys.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = max(1, math.ceil(sum(sizes.values()) / GRAMS_PER_BLOCK))
    found = None
    for block in range(blocks):
        part = keys.where(F.pmod(F.xxhash64("g", F.lit(1)), F.lit(blocks)) == block)
        hits, hit = places, F.col("at") == (-1 if block == 0 else -2)
        for m in sorted(sizes):
            known = part.where(F.col("m") == m).select(F.col("g").alias(f"g{m}"))
            rolling = F.xxhash64(*(F.get("ws", F.col("at") + j) for j in range(m)))
            inside = (F.col("at") >= 0) & (F.col("at") + m <= F.size("ws"))
            hits = hits.join(F.broadcast(known), F.when(inside, rolling) == F.col(f"g{m}"), "left")
            hit = hit | F.col(f"g{m}").isNotNull()
        whole = F.when(F.col("at") < 0, word_count(F.col("ws")))
        # A text that begins with a separator has an empty word in front.
        place = F.when(F.col("at") >= 0, F.col("at") - (F.element_at("ws", 1) == "").cast("int"))
        near = F.when(F.col("at") >= 0, F.slice("ws", F.greatest("at", F.lit(0)) + 1, gram))
        hits = hits.where(hit).select("k", "h", whole.alias("n_words"), place.alias("p"), near.alias("near"))
        found = hits if found is None else found.unionByName(hits)
    found = stored(found, "shared-grams")
    return found.where("p IS NULL").select("k", "h", "n_words"), found.where("p IS NOT NULL").select("k", "h", "p", "near")


def diagonals(hits: DataFrame, grams: DataFrame, gram: int) -> DataFrame:
    """Votes by text (k, h), template and diagonal (d): the distinct places qs of the template and its first word p0 and last p1."""
    found = None
    for m in range(1, gram + 1):
        own = hits.where(F.size("near") >= m).withColumn("near", F.slice("near", 1, m))
        own = own.withColumn("g", F.xxhash64(*(F.get("near", F.lit(j)) for j in range(m))))
        own = own.join(grams.where(F.col("m") == m), "g").where(F.col("near") == F.col("gw"))
        found = own if found is None else found.unionByName(own)
    keys = ["k", "h", "tid", "label", "exact", "n", "m", (F.col("p") - F.col("q")).alias("d")]
    ends = F.min("p").alias("p0"), F.max(F.col("p") + F.col("m")).alias("p1")
    return found.groupBy(*keys).agg(F.collect_set("q").alias("qs"), *ends)


def covered_words(places: str) -> Column:
    """Words of a template in grams of length m at these places."""
    words = F.transform(places, lambda q: F.sequence(q, q + F.col("m") - 1))
    return F.size(F.array_distinct(F.flatten(words)))


def verified_spans(votes: DataFrame, least_cover: int, near: int) -> DataFrame:
    """Spans (k, h, tid, label, exact, start, end, covered, n): whole phrases, and merged diagonals that cover enough."""
    whole = votes.where(F.col("exact") & (F.size("qs") == F.col("n") - F.col("m") + 1))
    phrases = whole.select("k", "h", "tid", "label", "exact", F.col("d").alias("start"), (F.col("d") + F.col("n")).alias("end"), F.col("n").alias("covered"), "n")
    order = Window.partitionBy("k", "h", "tid").orderBy("d")
    apart = F.col("d") - F.lag("d").over(order) > F.least(F.lit(near), F.floor(F.col("n") / 4))
    merged = votes.where(~F.col("exact")).withColumn("apart", F.coalesce(apart, F.lit(False)).cast("long"))
    merged = merged.withColumn("group", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    keys = ["k", "h", "tid", "label", "exact", "n", "m", "group"]
    spans = merged.select(*keys, "p0", "p1", F.explode("qs").alias("q")).groupBy(*keys)
    spans = spans.agg(F.min("p0").alias("start"), F.max("p1").alias("end"), F.collect_set("q").alias("qs"))
    spans = spans.withColumn("covered", covered_words("qs")).where(F.col("covered") * 100 >= F.col("n") * least_cover)
    return phrases.unionByName(spans.select(*phrases.columns))


def license_spans(
    docs: DataFrame,
    templates: DataFrame | None = None,
    gram: int = GRAM,
    least_cover: int = LEAST_COVER,
    near: int = NEAR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Documents (k, h, n_words) and the verified spans of templates in them.

    ``templates`` has tid, label, exact and text. Documents are known by id and a hash of the text.
    """
    spark = docs.sparkSession
    if templates is None:
        templates = template_table(spark, TEMPLATES, PHRASES)
    grams = stored(gram_table(templates, gram), "templates")
    rows, hits = shared_grams(docs, grams, gram, id_col, text_col)
    return rows, verified_spans(diagonals(hits, grams, gram), least_cover, near)


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame | None = None,
    gram: int = GRAM,
    least_cover: int = LEAST_COVER,
    near: int = NEAR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are the smallest and
    the largest of their starts (null without any), ``base_labels`` their labels; ``labels`` adds those of other templates; both are distinct,
    sorted and joined by commas. ``score`` is the largest share of a template's words that a span
    covers, 1 for a phrase and 0 without spans. Null and empty texts have no words. Repeated rows are kept as
    they are; rows that share an id count by themselves. Templates without words take no part. Without templates every
    score is 0. Other columns are not read.
    """
    rows, spans = license_spans(docs, templates, gram, least_cover, near, id_col, text_col)
    base = F.col("exact")
    found = spans.groupBy(F.col("k").alias("fk"), F.col("h").alias("fh")).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.col("covered") / F.col("n")).alias("score"),
    )
    rows = rows.join(found, F.col("k").eqNullSafe(F.col("fk")) & (F.col("h") == F.col("fh")), "left")
    return rows.select(
        F.col("k").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
