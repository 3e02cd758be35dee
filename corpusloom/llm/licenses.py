"""License scans: MinHash bands over overlapping windows, then exact containment; column functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import query, table

# Notices to look for, by licence.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 2
CONTAINMENT = 0.8
MISS = 1e-4  # chance that bands miss a window that holds a template


def least_likeness(wanted: int, c: int) -> float:
    """Of a template with so many shingles and a window of 2**(c+1) words that matches it, the least Jaccard likeness.

    The window holds no more of them than it must, and every other shingle in it is some other template's.
    """
    held = 2 ** (c + 1) - SHINGLE + 1
    must = next(i for i in range(1, wanted + 1) if i / wanted >= CONTAINMENT)
    return must / (wanted + max(held, must) - must)


def bands(least: float, miss: float = MISS) -> int:
    """How many bands of one MinHash each: windows of that likeness collide in none with chance `miss` at most."""
    return math.ceil(math.log(miss) / math.log(1 - least)) if least < 1 else 1


def with_hits(df: DataFrame, known: list[int] | None) -> DataFrame:
    """Adds `hits`: (pos, h) of the shingles of `text`; only of those in `known`, if given."""
    step = df.withColumn("_w", F.regexp_extract_all(
        F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit("([a-z0-9]+)")))
    n = F.size("_w")
    at = F.when(n < SHINGLE, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - SHINGLE))
    step = step.withColumn("_h", F.transform(at, lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(SHINGLE)])))
    each = F.transform("_h", lambda h, i: F.struct(i.alias("pos"), h.alias("h")))
    if known is not None:
        each = F.filter(F.transform("_h", lambda h, i: F.when(h.isin(known), F.struct(i.alias("pos"), h.alias("h")))),
                        lambda x: x.isNotNull())
    return step.withColumn("hits", each).drop("_w", "_h")


def min_hashes(shingles: Column, n: int) -> Column:
    """One value a band: the least hash of the set under the band's own hash function."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda b: F.xxhash64(
        b, F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b)))))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, licenses (names in order, joined by commas), n_windows, first_word, containment.

    A template of up to 2**c words is looked for in windows of 2**(c+1) words
    that start every 2**c words, so it lies whole in one of them. A window's set
    holds its shingles that some template has; others can't match and would
    only hide a match. Windows whose bands meet a template's are compared
    exactly: a match holds at least CONTAINMENT of the template's shingles.
    n_windows counts the matches, first_word is the start of the first window
    that has one, containment the best. Documents without any, null and empty
    texts have an empty string, 0, null and 0. Whole texts are scanned. Rows
    that repeat id and text get the same answer, null ids included. The
    templates are a parameter and small: their shingles go into the plan.
    """
    spark = docs.sparkSession
    rows = [(k, v) for k, v in sorted(templates.items())]
    given = with_hits(spark.createDataFrame(rows, "name string, text string"), None)
    words = F.size("hits") + SHINGLE - 1
    own = given.select(
        "name", F.array_distinct("hits.h").alias("wanted"), F.ceil(F.log2(words.cast("double"))).cast("int").alias("c")
    ).filter(F.size("wanted") > 0).collect()
    n = bands(min((least_likeness(len(r["wanted"]), r["c"]) for r in own), default=1.0))
    known = sorted({h for r in own for h in r["wanted"]})
    classes = sorted({r["c"] for r in own})
    wanted = spark.createDataFrame([(r["name"], r["wanted"], r["c"]) for r in own],
                                   "name string, wanted array<long>, c int")
    wanted = wanted.withColumn("band", F.explode(min_hashes(F.col("wanted"), n)))

    base = docs.select("doc_id", "text").withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    # outer, and the filter behind it: a filter on the array would repeat its whole computation
    hits = with_hits(base, known).select("doc_id", "tie", F.explode_outer("hits").alias("x")).filter("x is not null")
    placed = hits.select(
        "doc_id", "tie", F.col("x.h").alias("h"), "x.pos", F.explode(F.array(*[F.lit(c) for c in classes])).alias("c")
    ).withColumn("w", F.expr("cast(pos div shiftleft(1, c) as int)"))
    # a shingle of the window's last word would reach into the next one
    inside = F.filter(F.array("w", F.col("w") - 1), lambda w: (w >= 0) & (
        F.col("pos") + SHINGLE - 1 < (w + 2) * F.expr("shiftleft(1, c)")))
    windows = placed.select("doc_id", "tie", "c", "h", F.explode(inside).alias("w")).groupBy(
        "doc_id", "tie", "c", "w").agg(F.collect_set("h").alias("held"))
    met = windows.withColumn("band", F.explode(min_hashes(F.col("held"), n))).join(wanted, ["c", "band"])
    share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
    exact = met.withColumn("share", share).filter(F.col("share") >= CONTAINMENT).groupBy(
        "doc_id", "tie", "c", "w", "name").agg(F.max("share").alias("share"))
    found = exact.groupBy("doc_id", "tie").agg(
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("licenses"), F.count("*").alias("n_windows"),
        F.min(F.col("w").cast("long") * F.expr("shiftleft(1L, c)")).alias("first_word"), F.max("share").alias("containment"),
    ).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "licenses", "n_windows", "first_word", "containment")
    narrow = base.select("doc_id", "tie")
    return narrow.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left").select(
        "doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"), "first_word",
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def _sql() -> str:
    rows = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(TEMPLATES.items()))
    words = "regexp_extract_all(translate(coalesce({0}, ''), '" + UPPER + "', '" + LOWER + "'), '[a-z0-9]+')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH t(name, text) AS (VALUES {rows}),
tw AS (SELECT name, {words.format('text')} AS w FROM t),
wanted AS (SELECT name, list_distinct({grams}) AS g, ceil(log2(len(w)))::INT AS c FROM tw WHERE len(w) > 1),
known AS (SELECT DISTINCT unnest(g) AS h FROM wanted),
d AS (SELECT row_number() OVER () AS r, doc_id, {words.format('text')} AS w FROM documents),
s AS (SELECT r, unnest({grams}) AS h, unnest(range(0, len(w) - 1)) AS pos FROM d WHERE len(w) > 1),
hits AS (SELECT r, h, pos FROM s SEMI JOIN known USING (h)),
placed AS (SELECT r, h, pos, c, pos // (1 << c) - o AS wi FROM hits, (SELECT DISTINCT c FROM wanted), (VALUES (0), (1)) AS v(o)),
wins AS (SELECT r, c, wi, list(DISTINCT h) AS held FROM placed WHERE wi >= 0 AND pos + 1 < (wi + 2) * (1 << c) GROUP BY r, c, wi),
found AS (
  SELECT r, c, wi, name, len(list_intersect(held, g)) / len(g) AS share FROM wins JOIN wanted USING (c)
  WHERE len(list_intersect(held, g)) / len(g) >= {CONTAINMENT}),
agg AS (
  SELECT r, array_to_string(list_sort(list(DISTINCT name)), ',') AS licenses, count(*) AS n_windows,
    min(wi * (1 << c))::BIGINT AS first_word, max(share) AS containment FROM found GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_windows, 0)::BIGINT AS n_windows, first_word,
  coalesce(containment, 0)::DOUBLE AS containment FROM d LEFT JOIN agg USING (r)
"""


@query("op10_license_scan", _sql())
def op10_license_scan(spark, sf):
    return scanned(table(spark, sf, "documents"))
