"""License scan with SQL functions only.

Words are runs of ASCII letters and digits and of any other characters beyond ASCII, in
lower case; shingles are runs of ``SHINGLE`` words. Documents are cut into overlapping
windows of ``SIZE`` shingles that start at every ``STEP``-th one; a window has ``BANDS``
bands of ``ROWS`` min-hashes. The windows of a template start at each of its shingles. A
template is retrieved for a document if a band of any window agrees with one of its own;
then the document's whole shingle set is compared with the template's exactly, and it
matches if it holds at least ``CONTAINED`` of them.

Collision is certain where it matters. ``SIZE + STEP - 1`` shingles in a row that document
and template share hold a document window whole, and equal windows agree in every band. An
edit that spoils as few shingles as possible (a word put in) spoils ``SHINGLE - 1``, so a
template of n shingles that keeps 80 % of them has at most n / 20 edits inside and a run of
at least 0.8 n / (n / 20 + 1) shingles left: 6 or more from n = 11 on. From n = 6 to 10 no
edit inside leaves 80 %. Windows that differ agree with probability
1 - (1 - J^ROWS)^BANDS. Templates of fewer shingles are retrieved by windows of one
shingle, so surely.

Nulls and empties: null and empty texts match nothing. A text shorter than a shingle, or a
template, is one shingle of all its words; such a template is also found inside longer texts. A template without words is none; each row of
the templates is matched for itself, also if ids repeat. Each row gives its own matches. Extra
columns are ignored. Templates are a stated set on the driver: so many at a time as have
``BLOCK`` values (or one larger template) are held against all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.llm.shared import aside, once
from rollbook.llm.wordings import rows as wordings

SHINGLE, CONTAINED = 5, 0.8
SIZE, STEP, BANDS, ROWS = 4, 2, 2, 2
#: Shingles and band values of the templates that are looked for in one pass: what it sends is
#: 8 bytes a value.
BLOCK = 100_000

#: Notices as they stand in files and on pages (fixed wordings of public licenses).
NOTICES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}


def template_rows() -> list[tuple[str, str]]:
    """Ids and texts of the default templates."""
    return [(f"{name}/{i}", text) for name, texts in NOTICES.items() for i, text in enumerate(texts)] + wordings()


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_rows(), "template_id string, text string")


def words(text: Column) -> Column:
    """Words of a text; an array without empty ones."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def with_shingles(
    df: DataFrame, text: Column, name: str, brief: str | None = None, starts: dict[int, set[int]] | None = None
) -> DataFrame:
    """Adds ``name``: hashes of the runs of words, in order. And ``brief``, if given: those of
    the runs of fewer words than a shingle that begin with the ``starts`` of their length."""
    hidden = aside("words")
    df = once(df, hidden, F.transform(words(text), lambda w: F.xxhash64(w)))
    w = F.col(hidden)
    run = F.transform(
        F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)),
        lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(SHINGLE))),
    )

    def whole(x: Column) -> Column:
        return F.xxhash64(F.size(x), F.array_join(F.transform(x, lambda y: y.cast("string")), " "))

    if brief:
        found = [F.array().cast("array<bigint>")]
        for n, first in (starts or {}).items():
            at = F.filter(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.element_at(w, i).isin(*first))
            runs = F.transform(at, lambda i: whole(F.slice(w, i, n)))
            # Few texts have such a word at all.
            has = F.exists(w, lambda x: x.isin(*first))
            found.append(F.when((F.size(w) >= SHINGLE) & has, runs).otherwise(found[0]))
        df = once(df, brief, F.concat(*found))
    short = F.array(whole(w))
    return once(df, name, F.when(F.size(w) >= SHINGLE, run).when(F.size(w) > 0, short).otherwise(w)).drop(hidden)


def bands(h: Column, step: int) -> Column:
    """Band values of the windows of ``SIZE`` shingles; none if there are fewer."""

    def least(i: Column, seed: int) -> Column:
        # Nearness to a fixed number orders hashes at random, another number anew.
        return F.least(*(F.element_at(h, i + k).bitwiseXOR(F.lit(seed)) for k in range(SIZE)))

    def band(i: Column, b: int) -> Column:
        rows = (least(i, 0x1F3D5B79A2C4E608 * (b * ROWS + r + 1) % (1 << 63)) for r in range(ROWS))
        return F.xxhash64(F.lit(b), *rows)

    starts = F.sequence(F.lit(1), F.size(h) - (SIZE - 1), F.lit(step))
    found = F.flatten(F.transform(starts, lambda i: F.array(*(band(i, b) for b in range(BANDS)))))
    return F.when(F.size(h) >= SIZE, found).otherwise(F.array().cast("array<bigint>"))


def prepared(templates: DataFrame) -> list[dict]:
    """Templates with their shingle sets and the values they are retrieved by."""
    rows = with_shingles(templates.select("template_id", "text"), F.col("text"), "runs").where(F.size("runs") > 0)
    long = F.size("runs") >= SIZE + STEP - 1
    # Not named "h" before: inside a lambda that would be the distinct ones of this select.
    rows = rows.select(
        "template_id",
        F.array_distinct("runs").alias("h"),
        F.when(long, bands(F.col("runs"), 1)).otherwise(F.col("runs")).alias("keys"),
        long.alias("long"),
        F.size(words(F.col("text"))).alias("words"),
        F.xxhash64(F.element_at(words(F.col("text")), 1)).alias("first"),
    )
    return [r.asDict() for r in rows.collect()]


def _listed(values: set[int]) -> str:
    return ", ".join(f"{v}L" if v != -(1 << 63) else "(-9223372036854775807L - 1L)" for v in sorted(values)) or "NULL"


def _scan(docs: DataFrame, block: list[dict]) -> DataFrame:
    spark = docs.sparkSession
    singles = {k for t in block if not t["long"] for k in t["keys"]}
    windows = {k for t in block if t["long"] for k in t["keys"]}
    starts: dict[int, set[int]] = {}
    for t in block:
        if t["words"] < SHINGLE:
            starts.setdefault(t["words"], set()).add(t["first"])
    read = with_shingles(docs.select("doc_id", "text"), F.col("text"), "h", "brief", starts).drop("text")
    read = once(read, "b", bands(F.col("h"), STEP) if windows else F.array().cast("array<bigint>"))
    hits = F.concat(
        F.expr(f"filter(concat(brief, h), x -> x IN ({_listed(singles)}))"), F.expr(f"filter(b, x -> x IN ({_listed(windows)}))")
    )
    read = once(read, "hits", F.array_distinct(hits)).where(F.size("hits") > 0)
    sets = spark.createDataFrame(
        [(t["template_id"], t["h"], t["keys"]) for t in block], "template_id string, t array<bigint>, keys array<bigint>"
    )
    # BLOCK values at most: small enough to send.
    pairs = read.select("doc_id", F.concat("brief", "h").alias("h"), "hits").join(F.broadcast(sets), F.arrays_overlap("hits", "keys"))
    return pairs.select(
        "doc_id", "template_id", F.size(F.array_intersect("t", "h")).alias("matched"), F.size("t").alias("shingles")
    ).where(F.col("matched") >= F.col("shingles") * CONTAINED)


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per document and template in it: ``doc_id``, ``template_id``, ``matched``
    (of the template's distinct shingles), ``shingles`` (their number)."""
    blocks: list[list[dict]] = []
    room = 0
    for t in prepared(templates):
        size = len(t["h"]) + len(t["keys"])
        if size > room:
            blocks.append([])
            room = BLOCK
        blocks[-1].append(t)
        room -= size
    out = None
    for block in blocks:
        part = _scan(docs, block)
        out = part if out is None else out.unionByName(part)
    schema = "doc_id bigint, template_id string, matched int, shingles int"
    return docs.sparkSession.createDataFrame([], schema) if out is None else out
