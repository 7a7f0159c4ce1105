"""License scans: MinHash bands over overlapping windows, then exact containment; built-ins only.

Words are runs of letters and digits, lower-cased; shingles are five words. Templates fall into
classes by length; a class slides windows of its length and a quarter over the text, a quarter
apart, so that every occurrence lies whole in a window. One minimum of each of `bands` hashes (bands
of one row) is taken over a window's shingles, and equal minima retrieve templates. A class has as
many bands as make a window that holds LEAST of its shortest template collide with MISS or less
chance of a miss. Retrieved pairs are checked on the words: the share of the template's distinct
shingles in the window must be LEAST or more.

A band can only collide where a window holds a shingle of a template, so windows that hold none are
not built. Hashes of up to INLINE shingles of templates are looked up inside the row; of more, by a
join of the texts' shingles with the templates'. Both give the same places.

Templates are a table (license, text) of any size that the caller gives. Their words, bands and
shingles stay tables; a join broadcasts them only behind their measured size, and is a salted
shuffle beyond it. The default ones are common notices.

Defined results: null and empty texts match nothing; templates of fewer than five words are one
shingle, empty ones are no template; rows that repeat a doc_id are scanned alike and give one row a
license; a null doc_id stays null; further columns are ignored; empty tables of documents or
templates match nothing; a long text is one row, and its windows are rows of their own. With few
templates no document is shuffled but the few matches, to bring the windows of one document and
license together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import Dictionary, lookup
from .common import stage, table
from .fingerprints import let

SHINGLE = 5
LEAST = 0.75
MISS = 1e-5
#: Hashes of template shingles that a query holds as literals.
INLINE = 20_000

# Notices as licenses are commonly named.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        " License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,"
        " either express or implied.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "license string, text string")


def plain_words(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, "[^\\p{L}\\p{N}]+"), "")


def shingle(words: Column, i: Column) -> Column:
    return F.array_join(F.slice(words, i + 1, SHINGLE), " ")


def shingle_hashes(words: Column) -> Column:
    """Hashes of a text's shingles in order (of one, if it has fewer words)."""
    steps = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
    hashed = F.transform(
        steps, lambda i: F.xxhash64(*[F.get(words, i + place) for place in range(SHINGLE)])
    )
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(hashed)


def class_of(words: int) -> int:
    """The length class of a template: 8, 12, 16, 24, 32, 48, ..."""
    size = 8
    while size < words:
        size = size * 3 // 2 if size & (size - 1) == 0 else size * 4 // 3
    return size


def geometry(length: int) -> tuple[int, int]:
    """Shingles in a window of a class, and the words between windows."""
    step = max(2, length // 4)
    return length + step - SHINGLE, step


def bands_for(fewest: float) -> int:
    """Bands with which two sets of at least this resemblance collide, but for a chance of MISS."""
    return max(1, math.ceil(math.log(MISS) / math.log(1 - min(fewest, 0.999))))


def resemblance(length: Column) -> Column:
    """Of a template's shingles and those of a window of its class that holds LEAST of them."""
    own = F.size(F.array_distinct("h"))
    need = F.ceil(F.lit(LEAST) * own)
    step = F.greatest(F.floor(length / 4), F.lit(2))
    return need / (length + step - SHINGLE + own - need)


def signature(hashes: Column, bands: int) -> Column:
    """The least of each band's hashes over a window's shingles."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band))),
    )


def split(text: Column) -> Column:
    """Words and shingle hashes of a text."""
    return let(plain_words(text), lambda w: F.struct(w.alias("w"), shingle_hashes(w).alias("h")))


def find_licenses(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """(doc_id, license, first_word, containment): each license of a document once, with the first
    word of the first window that holds most of it and the share it holds."""
    spark = docs.sparkSession
    templates = notices(spark) if templates is None else templates
    known = templates.where(F.col("license").isNotNull()).select("license", split(F.col("text")).alias("t"))
    known = stage(known.select("license", "t.*").where(F.size("w") > 0), "templates")
    longest = known.agg(F.max(F.size("w"))).first()[0]
    nothing = spark.createDataFrame(
        [], "doc_id long, license string, first_word long, containment double"
    )
    if longest is None:
        return nothing
    sizes = [class_of(1)]  # they grow by a third or more, so there are few, whatever the templates
    while sizes[-1] < longest:
        sizes.append(class_of(sizes[-1] + 1))
    fitting = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n >= F.size("w"))
    known = known.withColumn("length", F.array_min(fitting))
    classes = known.groupBy("length").agg(F.min(resemblance(F.col("length"))).alias("fewest")).collect()

    rows = _with_places(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), known)
    rows = stage(rows, "licenses")  # texts are read once, whatever the number of classes
    found = nothing
    for row in sorted(classes):
        own = known.where(F.col("length") == row["length"])
        found = found.unionByName(_scanned(rows, row["length"], bands_for(row["fewest"]), own))
    return found.groupBy("doc_id", "license").agg(
        F.min_by("first_word", F.struct(-F.col("containment"), "first_word")).alias("first_word"),
        F.max("containment").alias("containment"),
    )


def _with_places(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, t, near) of texts with a shingle of a template; near are its places, in order."""
    hashes = stage(known.select(F.explode("h").alias("h")).distinct(), "shingles")
    if hashes.count() <= INLINE:
        literals = sorted(row["h"] for row in hashes.collect())
        near = let(
            F.col("t.h"),
            lambda hs: F.filter(
                F.sequence(F.lit(0), F.greatest(F.size(hs) - 1, F.lit(0))),
                lambda i: F.get(hs, i).isin(literals),
            ),
        )
        rows = docs.select("doc_id", split(F.col("text")).alias("t"))
        return rows.select("doc_id", "t", near.alias("near")).where(F.size("near") > 0)
    texts = Dictionary(hashes)
    same = F.md5(F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))))
    docs = docs.select("doc_id", "text", same.alias("same"))
    places = docs.select("same", F.posexplode(split(F.col("text"))["h"]).alias("at", "h"))
    met = lookup(places, texts.df, ["h"], "left_semi", small=texts.small)
    near = Dictionary(met.groupBy("same").agg(F.sort_array(F.collect_set("at")).alias("near")))
    return lookup(docs, near.df, ["same"], small=near.small).select(
        "doc_id", split(F.col("text")).alias("t"), "near"
    )


def _scanned(rows: DataFrame, length: int, bands: int, own: DataFrame) -> DataFrame:
    """Matches of one class of templates."""
    window, step = geometry(length)

    def shingles(words: Column) -> Column:
        steps = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
        return F.transform(steps, lambda i: shingle(words, i))

    banded = Dictionary(
        own.select(
            "license",
            F.array_distinct(shingles(F.col("w"))).alias("shingles"),
            F.posexplode(signature(F.array_distinct("h"), bands)).alias("band", "least"),
        )
    )
    numbers = F.array_distinct(
        F.flatten(
            F.transform(
                "near",
                lambda i: F.sequence(
                    F.greatest(F.ceil((i - window + 1) / step).cast("int"), F.lit(0)),
                    F.floor(i / step).cast("int"),
                ),
            )
        )
    )
    windows = F.transform(
        numbers,
        lambda k: F.struct(
            (k * step).cast("long").alias("first_word"),
            F.slice("t.w", k * step + 1, window + SHINGLE - 1).alias("words"),
            F.slice("t.h", k * step + 1, window).alias("hashes"),
        ),
    )
    cut = rows.select("doc_id", F.explode(windows).alias("v")).select("doc_id", "v.*")
    cut = cut.select(
        "doc_id",
        "first_word",
        "words",
        F.posexplode(signature(F.col("hashes"), bands)).alias("band", "least"),
    )
    met = lookup(cut, banded.df, ["band", "least"], small=banded.small)
    held = shingles(F.col("words"))
    share = F.size(F.array_intersect("shingles", held)) / F.size("shingles")
    return met.select("doc_id", "license", "first_word", share.alias("containment")).where(
        F.col("containment") >= LEAST
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op8: the licenses of every document."""
    return find_licenses(table(spark, folder, "documents"))


def _oracle() -> str:
    """All windows of all classes, compared with all templates."""
    quoted = ", ".join(f"('{name}', '{text}')" for name, text in NOTICES)
    plain = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
    classes = ", ".join(
        f"({length}, {geometry(length)[0]}, {geometry(length)[1]})"
        for length in (8, 12, 16, 24, 32, 48, 64)
    )
    return f"""
WITH templates(license, text) AS (VALUES {quoted}),
classes(len, win, step) AS (VALUES {classes}),
split AS (SELECT license, {plain} AS w FROM templates),
known AS (
  SELECT license, (SELECT min(len) FROM classes WHERE len >= len(w)) AS len, w,
    unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split),
shingles AS (
  SELECT DISTINCT license, len, array_to_string(w[i : i + 4], ' ') AS s FROM known),
totals AS (SELECT license, count(*) AS n FROM shingles GROUP BY license),
words AS (SELECT doc_id, {plain} AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM words
        WHERE len(w) > 0)),
met AS (
  SELECT doc_id, license, s, unnest(range(
      greatest(ceil((i - win + 1) / step)::BIGINT, 0), (i // step) + 1)) * step AS first_word
  FROM places JOIN shingles USING (s) JOIN classes USING (len)),
held AS (
  SELECT doc_id, license, first_word, count(DISTINCT s) / any_value(n)::DOUBLE AS containment
  FROM met JOIN totals USING (license) GROUP BY doc_id, license, first_word)
SELECT doc_id, license, min_by(first_word, first_word - containment * 1e12) AS first_word,
  max(containment) AS containment
FROM held WHERE containment >= 0.75 GROUP BY doc_id, license
"""


ORACLE = _oracle()
