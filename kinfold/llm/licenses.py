"""License scans in DataFrame functions only: MinHash bands over overlapping windows, then exact
containment.

A text's 3-word shingles are hashed in order.  Windows of four shingles, one at every second
shingle, give a key a band: the shingle that is nearest to the band's mark in the XOR order, which
makes any of the four equally likely.  A template is cut into windows at *every* shingle, so an
unchanged run of five shingles holds a window that equals one of the template's, and all bands
agree.  A window with one changed shingle has Jaccard similarity 3/5 and agrees in one of four
bands with probability 1 - (2/5)**4 = 0.974 were the bands independent, a little more as they are
(the test measures it); templates have many windows.  Templates of under
five shingles have windows of one shingle, which agree if equal.

A template that shares a key is verified: a match has at least ``least`` of the template's shingles
in the text.  Templates are a parameter and travel as literals, so nothing is shuffled, and a text
is scanned where it lies.

Words are runs of letters and digits, A-Z lower-cased.

Cases: a null or empty text matches nothing; repeated rows match each; templates need three words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import ascii_lower, text_or_empty

TERM = r"[\p{L}\p{N}]+"
SHINGLE, WINDOW, STRIDE = 3, 4, 2
#: The bands' marks, spread over the hash space.
MARKS = [0x1B873593CC9E2D51, -0x61C8864680B583EB, 0x52DCE729DA3ED7A1, -0x2545F4914F6CDD1D]

#: Notices by which texts are placed under a licence, and openings of licence texts.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-header": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, working ``value`` out once."""
    return F.get(F.transform(F.array(value), then), 0)


def shingles(text: Column) -> Column:
    """Hashes of the text's shingles in order."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(f"({TERM})"), F.lit(1))

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - SHINGLE)
        return F.when(F.size(w) >= SHINGLE, F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashed)


def band_keys(h: Column, stride: int) -> Column:
    """The bands' keys of all windows of the shingles ``h``."""

    def keys(i: Column) -> Column:
        return F.array(*[F.least(*[F.get(h, i + j).bitwiseXOR(F.lit(m)) for j in range(WINDOW)]).bitwiseXOR(F.lit(m + b)) for b, m in enumerate(MARKS)])

    starts = F.sequence(F.lit(0), F.size(h) - WINDOW, F.lit(stride))
    return F.when(F.size(h) >= WINDOW, F.flatten(F.transform(starts, keys))).otherwise(F.array().cast("array<bigint>"))


def library(spark, templates: dict[str, str]) -> list[dict]:
    """Each template's distinct shingles and keys.  The templates are a parameter, so their number
    is the caller's."""
    rows = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(v).alias("text")) for k, v in templates.items()])).alias("t"))
    rows = rows.select("t.name", shingles(F.col("t.text")).alias("h"))
    rows = rows.select("name", F.array_distinct("h").alias("shingles"), F.when(F.size("h") > WINDOW, F.array_distinct(band_keys(F.col("h"), 1))).otherwise(F.col("h")).alias("keys"), (F.size("h") <= WINDOW).alias("short"))
    found = [r.asDict() for r in rows.collect()]
    if any(not t["shingles"] for t in found):
        raise ValueError(f"a template needs {SHINGLE} words")
    return found


def scan(docs: DataFrame, templates: dict[str, str], column: str = "text", least: float = 0.8, matches: str = "matches") -> DataFrame:
    """``docs`` with ``matches``: array of struct (template, containment, first_word)."""
    known = library(docs.sparkSession, templates)
    table = F.array(*[F.struct(F.lit(t["name"]).alias("name"), F.lit(t["keys"]).cast("array<bigint>").alias("keys"), F.lit(t["shingles"]).cast("array<bigint>").alias("shingles")) for t in known])
    any_long = F.lit(sorted({k for t in known if not t["short"] for k in t["keys"]}) or [0])
    any_short = F.lit(sorted({k for t in known if t["short"] for k in t["keys"]}) or [0])

    def matched(h: Column, keys: Column) -> Column:
        def measured(t: Column) -> Column:
            shared = F.array_intersect(t["shingles"], h)
            first = F.array_min(F.transform(shared, lambda s: F.array_position(h, s)))
            return F.struct(t["name"].alias("template"), (F.size(shared) / F.size(t["shingles"])).alias("containment"), first.alias("first_word"))

        met = F.filter(table, lambda t: F.arrays_overlap(keys, t["keys"]))
        return F.filter(F.transform(met, measured), lambda m: m["containment"] >= least)

    def candidates(h: Column) -> Column:
        # single shingles are the windows of short templates; long ones are met by their bands
        return let(F.concat(F.array_intersect(band_keys(h, STRIDE), any_long), F.array_intersect(h, any_short)), lambda keys: F.when(F.size(keys) > 0, matched(h, keys)))

    none = F.array().cast("array<struct<template:string,containment:double,first_word:bigint>>")
    return docs.withColumn(matches, F.coalesce(let(shingles(text_or_empty(column)), candidates), none))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, TEMPLATES).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", F.col("m.template").alias("template"), F.col("m.containment").alias("containment"), F.col("m.first_word").alias("first_word"))


def _sql() -> str:
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    grams = "CASE WHEN len(w) < 3 THEN [] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END"
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{L}\p{N}]+')"
    return f"""
WITH t AS (SELECT name, list_distinct({grams}) AS s FROM (SELECT name, {words} AS w FROM (VALUES {values}) v(name, text))),
d AS (SELECT doc_id, {grams} AS g FROM (SELECT doc_id, {words} AS w FROM documents)),
m AS (SELECT doc_id, name, g, s, list_filter(s, lambda x: list_contains(g, x)) AS shared FROM d, t)
SELECT doc_id, name AS template, len(shared) / len(s) AS containment, list_min(list_transform(shared, lambda x: list_position(g, x)))::BIGINT AS first_word
FROM m WHERE len(shared) >= 0.8 * len(s)
"""


OP10_SQL = _sql()
