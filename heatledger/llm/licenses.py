"""License scans: MinHash bands over overlapping text windows, verified by exact shingle containment.

Texts and templates become five-word shingles of lower-cased words without punctuation. Text windows of ``WINDOW`` shingles overlap
by half; each has one minimum for every band, the smallest shingle hash xor the band's constant. Every
window of a template has the same minima, so an occurrence meets the template where two windows share
a band. A window inside an exact occurrence equals a template window and shares all bands; one that keeps a
share J of the shingles is met with probability 1 - (1 - J) ** BANDS, 99.7 % at J = 0.5. Templates of fewer
than ``WINDOW + STRIDE - 1`` shingles may hold no whole text window, so for them windows of one shingle are
used, whose minimum is the shingle and which any common shingle meets for certain; templates shorter than
five words are one shingle of their own length.

Each meeting gives a place; the shingles of the text there that the template also has, over the template's
shingles, are the containment, which must reach 0.8. Everything is native expressions: one scan, no
shuffle of texts, and a join of the few meetings with the templates' bands.

Defined results: null and empty texts match nothing; rows that repeat an id count as one document; null
ids are reported together under null; empty tables give empty results; only named columns are read.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, WINDOW, STRIDE, BANDS = 5, 8, 4, 8
#: Constants of the bands.
BAND_KEYS = [random.Random(2024 + k).getrandbits(64) - (1 << 63) for k in range(BANDS)]
#: Band numbers of one-shingle windows, and of templates of fewer than five words (minus their length).
ONE, SHORT = -1, -10

#: Notices as their licences publish them: (name, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]


def word_hashes(text: Column) -> Column:
    """Hash of each word of the text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column) -> Column:
    """Hash of the shingle at each word; those of the last words are shorter and equal no full one."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))


def window_minimum(shingles: Column, at: Column, key: Column) -> Column:
    """Smallest of the window's shingle hashes xor the band's constant; ``at`` counts from 0."""
    return F.array_min(F.transform(F.slice(shingles, at + 1, F.lit(WINDOW)), lambda x: x.bitwiseXOR(key)))


def template_frame(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """Rows (template, license, n, words, shingles) of the catalogue; n counts full shingles, 1 for shorter templates."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string").coalesce(1)
    with_words = rows.withColumn("words", word_hashes(F.col("text")))
    full = F.slice(shingle_hashes(F.col("words")), F.lit(1), F.greatest(F.lit(1), F.size("words") - SHINGLE + 1))
    return with_words.filter(F.size("words") > 0).withColumn("shingles", full).withColumn("n", F.size("shingles")).drop("text")


def band_frame(catalogue: DataFrame) -> DataFrame:
    """Rows (band, v, template, license, place, n, width, shingles): what each template's windows meet."""
    keep = ["template", "license", "n", "shingles"]
    width = F.least(F.size("words"), F.lit(SHINGLE)).alias("width")
    few = F.col("n") < WINDOW + STRIDE - 1
    short = catalogue.filter(F.size("words") < SHINGLE).select((F.lit(SHORT) - F.size("words")).alias("band"), F.element_at("shingles", 1).alias("v"), F.lit(0).alias("place"), width, *keep)
    one = catalogue.filter((F.size("words") >= SHINGLE) & few).select(width, *keep, F.posexplode("shingles").alias("place", "v")).withColumn("band", F.lit(ONE))
    starts = catalogue.filter((F.size("words") >= SHINGLE) & ~few).select(width, *keep, F.explode(F.sequence(F.lit(0), F.col("n") - WINDOW)).alias("place"))
    keys = F.array(*[F.lit(k).cast("long") for k in BAND_KEYS])
    many = starts.select("width", *keep, "place", F.posexplode(F.transform(keys, lambda k: window_minimum(F.col("shingles"), F.col("place"), k))).alias("band", "v"))
    cols = ["band", "v", "place", "width", *keep]
    return short.select(*cols).unionByName(one.select(*cols)).unionByName(many.select(*cols)).withColumn("band", F.col("band").cast("int"))


def _short_spots(words: Column, size: int, hashes: list[int], firsts: list[int]) -> Column:
    """Structs for the places where ``size`` words hash to one of ``hashes``; only after a word of ``firsts`` is anything hashed."""

    def spot(w: Column, i: Column) -> Column:
        here = F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)])
        return F.when(w.isin(firsts) & here.isin(hashes), F.struct(i.alias("at"), F.lit(SHORT - size).alias("band"), here.alias("v")))

    return F.filter(F.transform(words, spot), lambda s: s.isNotNull())


def meetings(words: Column, shingles: Column, bands: list) -> Column:
    """Array of structs (at, band, v): where the text's windows share a value with any template."""
    keys = F.array(*[F.lit(k).cast("long") for k in BAND_KEYS])
    values = {name: sorted({r.v for r in bands if cond(r.band)}) for name, cond in (("many", lambda b: b >= 0), ("one", lambda b: b == ONE))}
    parts = []
    if values["many"]:
        starts = F.when(F.size(shingles) > 0, F.sequence(F.lit(0), F.size(shingles) - 1, F.lit(STRIDE))).otherwise(F.array().cast("array<int>"))
        near = lambda at: F.filter(
            F.transform(keys, lambda k, j: F.struct(at.alias("at"), j.alias("band"), window_minimum(shingles, at, k).alias("v"))), lambda s: s["v"].isin(values["many"])
        )
        parts.append(F.flatten(F.transform(starts, near)))
    if values["one"]:
        spots = F.transform(shingles, lambda x, i: F.when(x.isin(values["one"]), F.struct(i.alias("at"), F.lit(ONE).alias("band"), x.alias("v"))))
        parts.append(F.filter(spots, lambda s: s.isNotNull()))
    for size in sorted({SHORT - r.band for r in bands if r.band < SHORT}):
        own = [r for r in bands if r.band == SHORT - size]
        parts.append(_short_spots(words, size, sorted({r.v for r in own}), sorted({r.first for r in own})))
    return F.concat(*parts)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = 0.8) -> DataFrame:
    """Rows (doc_id, template, license, containment, start_word, n_places): the templates that each document holds.

    ``start_word`` is where the best place begins (the first of equals), ``n_places`` how many alignments reach ``least``.
    """
    spark = docs.sparkSession
    catalogue = template_frame(spark, TEMPLATES if templates is None else templates)
    table = band_frame(catalogue)
    first_words = catalogue.select("template", F.element_at("words", 1).alias("first"))
    bands = table.join(first_words, "template").select("band", "v", "first").distinct().collect()  # bounded by the catalogue
    longest = catalogue.agg(F.max("n")).first()[0] or 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_hashes(F.col("text")).alias("words"))
    rows = rows.withColumn("shingles", shingle_hashes(F.col("words")))
    met = rows.select("doc_id", "shingles", F.explode_outer(meetings(F.col("words"), F.col("shingles"), bands)).alias("m")).filter("m IS NOT NULL")
    low = F.greatest(F.lit(0), F.col("m.at") - 2 * longest)
    near = met.select("doc_id", F.col("m.at").alias("at"), F.col("m.band").alias("band"), F.col("m.v").alias("v"), low.alias("low"), F.slice("shingles", low + 1, F.lit(4 * longest)).alias("near"))
    pairs = near.join(F.broadcast(table.withColumnRenamed("shingles", "own")), ["band", "v"])  # a row for each window of the catalogue and band
    start = F.col("at") - F.col("place")
    slack = F.ceil(F.col("n") / 4).cast("int")
    begin = F.greatest(F.lit(0), start - slack - F.col("low"))
    here = F.slice("near", begin + 1, F.greatest(F.lit(1), start + F.col("n") + slack - F.col("low") - begin))
    distinct = F.size(F.array_distinct("own"))
    contained = F.when(F.col("band") < SHORT, F.lit(1.0)).otherwise(F.size(F.array_intersect(here, "own")) / distinct)
    placed = pairs.select("doc_id", "template", "license", F.greatest(F.lit(0), start).alias("start"), contained.alias("containment")).filter(F.col("containment") >= least)
    best = F.max(F.struct("containment", (-F.col("start")).alias("s"))).alias("best")
    out = placed.groupBy("doc_id", "template", "license").agg(best, F.count_distinct("start").alias("n_places"))
    return out.select("doc_id", "template", "license", F.col("best.containment").alias("containment"), (-F.col("best.s")).cast("long").alias("start_word"), "n_places")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against the catalogue of notices."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
