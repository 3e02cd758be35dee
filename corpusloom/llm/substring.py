"""Substring dedup: a de Bruijn graph of token k-mers, compacted with joins, verified at the source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import (
    dropped, mix, query, sieve, signed, small_batches, stored, table, window_hashes, with_may_be_in, word_hashes,
    words_of,
)

OTHER = np.uint64(0x9E3779B97F4A7C15)  # sets the second hash of a window apart
KMER = 18  # least words of an edge where the window has as many


def edge_words(window: int) -> int:
    """Words of an edge: no more than a window, and more than half of it.

    A window of w words has w - k + 1 edges to choose from, and neighbouring
    chosen edges start at most so many words apart. With k > w / 2 that is no
    more than k, so they touch or overlap and no word between them is left out.
    """
    return min(max(KMER, window // 2 + 1), window)


def least_places(k: np.ndarray, reach: int) -> np.ndarray:
    """For every run of `reach` k-mers, the place of its least one, the leftmost of equals."""
    best, at, size = k, np.arange(len(k)), 1
    while size < reach:  # best[i] is the least of `size` from i on
        step = min(size, reach - size)
        m = len(best) - step
        right = best[step:] < best[:m]
        best, at = np.where(right, best[step:], best[:m]), np.where(right, at[step:], at[:m])
        size += step
    return at


class Text:
    """Words of a text, the k-mers chosen as its edges, and the windows they stand for.

    Each window chooses its least k-mer, by content alone, so equal windows
    choose equal edges: a window can only repeat if its edge does. Neighbouring
    edges touch or overlap (`edge_words`).
    """

    def __init__(self, text: str | None, window: int) -> None:
        self.words = words_of(text)
        self.hashes = word_hashes(self.words)
        self.window = window
        if len(self.hashes) < window:
            self.at = self.owner = np.zeros(0, np.int64)
            self.edges = np.zeros(0, np.uint64)
            return
        size = edge_words(window)
        k = window_hashes(self.hashes, size)
        self.at, self.owner = np.unique(least_places(k, window - size + 1), return_inverse=True)
        self.edges = k[self.at]


def sequences(docs: DataFrame, window: int) -> DataFrame:
    """uid, and the chosen edges of the text in order with their places; none below a window."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, t in zip(b["uid"], b["_text"], strict=True):
                x = Text(t, window)
                if len(x.at):
                    rows.append((u, signed(x.edges), x.at))
            yield pd.DataFrame(rows, columns=["uid", "edges", "at"])

    return docs.mapInPandas(build, "uid binary, edges array<long>, at array<long>")


def paths(repeated: DataFrame) -> DataFrame:
    """(e, head): for every repeated edge, the first edge of the nonbranching path it is on.

    Input: (uid, i, e, next), i counting the edges of a text and next the one
    after; an edge that does not repeat is on no path. Two edges that follow
    each other are on one path if the first has no other successor and the
    second no other predecessor. Paths are compacted by pointer doubling: after
    r rounds an edge knows the one 2**r before it, so a path of n edges takes
    log2(n) joins. Edges on a cycle stay paths of their own.
    """
    known = stored(repeated.select("e").distinct())
    told = repeated.filter("next is not null").select("e", "next").distinct()
    steps = stored(told.join(known.withColumnRenamed("e", "next"), "next").select("e", "next"))
    only_out = steps.groupBy("e").agg(F.min("next").alias("next"), F.count("*").alias("m")).filter("m = 1")
    only_in = steps.groupBy("next").agg(F.min("e").alias("prev"), F.count("*").alias("m")).filter("m = 1")
    inner = only_out.drop("m").join(only_in.drop("m"), "next").filter("e = prev and e <> next")
    before = inner.select(F.col("next").alias("e"), "prev")
    now = stored(
        known.join(before, "e", "left").select("e", F.coalesce("prev", "e").alias("head"))
    )
    rounds = int(repeated.agg(F.coalesce(F.max("i"), F.lit(0))).first()[0] + 2).bit_length()
    for _ in range(rounds):  # a path without a cycle is no longer than the longest text's edges
        above = now.select(F.col("e").alias("head"), F.col("head").alias("above"))
        moved = stored(
            now.join(above, "head").select("e", F.col("above").alias("head"), (F.col("above") != F.col("head")).alias("on"))
        )
        dropped(now)
        now = moved
        if now.filter("on").isEmpty():
            break
    first = now.join(before.select("e"), "e", "left_anti").select(F.col("e").alias("head"), F.lit(True).alias("ends"))
    return now.select("e", "head").join(first, "head", "left").select(
        "e", F.when(F.col("ends"), F.col("head")).otherwise(F.col("e")).alias("head")
    )


def runs(repeated: DataFrame, heads: DataFrame) -> DataFrame:
    """uid, copies, and its runs: stretches of one path, by first and last edge (a, z), whether shared, whether first of its kind.

    A run's key stands for its edges and their distances. Neighbouring edges
    overlap or touch, whatever the window, so equal keys mean equal words from
    the first edge to the last. A run is shared if its key occurs twice; the first occurrence of a
    shared key answers for all.
    """
    names = ["i", "at", "e", "head"]
    lines = repeated.join(heads, "e").groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct(*names))).alias("x"), F.first("copies").alias("copies")
    ).select("uid", "copies", *[F.col("x")[n].alias(n) for n in names])  # plain arrays, which tasks get without objects

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, c, i, at, e, head in zip(b["uid"], b["copies"], *(b[n] for n in names), strict=True):
                ends = np.flatnonzero((np.diff(i) != 1) | (np.diff(head) != 0)) + 1
                for a, z in zip(np.append(0, ends), np.append(ends, len(i)), strict=True):
                    told = np.concatenate((e[a:z], at[a:z] - at[a])).astype(np.int64)
                    rows.append((u, c, int(i[a]), int(i[z - 1]), xxhash.xxh3_128_digest(told.tobytes())))
            yield pd.DataFrame(rows, columns=["uid", "copies", "a", "z", "key"])

    found = stored(lines.mapInPandas(cut, "uid long, copies long, a long, z long, key binary"))
    shared = found.groupBy("key").agg(
        F.sum(F.least("copies", F.lit(2))).alias("m"), F.min(F.struct("uid", "a")).alias("lead")
    ).filter("m > 1").select(F.col("key").alias("_k"), "lead")
    marked = found.join(shared, F.col("key") == F.col("_k"), "left").withColumn(
        "leads", F.coalesce(F.col("lead") == F.struct("uid", "a"), F.lit(False))
    )
    return marked.groupBy("uid", "copies").agg(
        F.collect_list(F.struct("a", "z", F.col("lead").isNotNull().alias("shared"), "leads")).alias("x")
    ).select("uid", "copies", *[F.col("x")[n].alias(n) for n in RUN])


RUN = ["a", "z", "shared", "leads"]


def _inside(x: Text, a: int, z: int) -> tuple[int, int]:
    """First start, and end of starts, of the windows between a run's first edge and its last."""
    return int(x.at[a]), int(x.at[z]) + edge_words(x.window) - x.window + 1


def key_of(text: str) -> Column:
    """128 bits that identify a text."""
    return F.unhex(F.md5(text))


def kept_texts(docs: DataFrame, window: int) -> DataFrame:
    """(uid, n_removed, kept) of the texts that lose words; input (uid, _text), one row per document."""
    small_batches(docs.sparkSession)
    reps = stored(
        sequences(docs, window).groupBy("uid").agg(F.count("*").alias("copies"), F.first("edges").alias("edges"), F.first("at").alias("at"))
        .withColumn("u", F.monotonically_increasing_id())  # stands for the key in all that follows
    )
    flat = reps.select(F.col("u").alias("uid"), "copies", "edges", F.posexplode(F.arrays_zip("edges", "at")).alias("i", "x")).select(
        "uid", "copies", "i", F.col("x.edges").alias("e"), F.col("x.at").alias("at"),
        F.get("edges", F.col("i") + 1).alias("next"),
    )
    often = flat.groupBy("e").agg(F.sum(F.least("copies", F.lit(2))).alias("m")).filter("m > 1").select("e")
    # stored before the join, so that adaptive execution may split the rows of a frequent edge
    often = stored(often)
    repeated = stored(flat.join(often, "e"))
    dropped(often)
    keys = reps.select(F.col("u").alias("uid"), F.col("uid").alias("_key"))
    touched = stored(runs(repeated, paths(repeated)).join(keys, "uid"))
    dropped(repeated)
    dropped(reps)
    texts = sieve(docs, "uid", touched.select(F.col("_key").alias("uid"))).groupBy(F.col("uid").alias("_key")).agg(
        F.first("_text").alias("_text"))
    source = stored(touched.join(texts, "_key"))
    dropped(touched)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def told(parts: list[tuple]) -> pd.DataFrame:
            h, g, w, u, start = (np.concatenate([p[k] for p in parts]) for k in range(5))
            return pd.DataFrame({"h": h, "g": g, "w": w, "uid": u, "start": start})

        parts, size = [], 0
        for b in batches:
            for u, c, t, *found in zip(b["uid"], b["copies"], b["_text"], *(b[n] for n in RUN), strict=True):
                x = Text(t, window)
                seen = np.zeros(len(x.at), bool)
                for a, z, *_ in zip(*found, strict=True):
                    seen[a : z + 1] = True
                start = np.flatnonzero(seen[x.owner])
                w = np.full(len(x.hashes), min(c, 2))
                for a, z, shared, leads in zip(*found, strict=True):
                    lo, hi = _inside(x, a, z)
                    if shared and hi > lo:
                        w[lo:hi] = 2 if leads else 0
                start = start[w[start] > 0]
                if len(start):
                    h, g = window_hashes(x.hashes, window), window_hashes(mix(x.hashes + OTHER), window)
                    parts.append((signed(h[start]), signed(g[start]), w[start], np.full(len(start), u), start))
                    size += len(start)
                if size >= 200_000:
                    yield told(parts)
                    parts, size = [], 0
        if parts:
            yield told(parts)

    told = source.mapInPandas(windows, "h long, g long, w int, uid long, start int")
    # two hashes of independent word hashes' mixes: 128 bits tell windows apart
    twice = stored(told.groupBy("h", "g").agg(F.sum("w").alias("m")).filter("m > 1").select("h", "g"))
    starts = told.filter("w = 1").join(twice, ["h", "g"]).groupBy("uid").agg(F.collect_list("start").alias("starts"))
    given = source.join(starts, "uid", "left").select("_key", "copies", *RUN, "_text", "starts")

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, c, t, s, *found in zip(
                    b["_key"], b["copies"], b["_text"], b["starts"], *(b[n] for n in RUN), strict=True):
                x = Text(t, window)
                change = np.zeros(len(x.words) + 1, np.int64)
                begin = np.asarray(s if s is not None else [], np.int64)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + window, -1)
                for a, z, shared, _ in zip(*found, strict=True):
                    lo, hi = _inside(x, a, z)
                    if shared and hi > lo:
                        change[lo] += 1
                        change[hi - 1 + window] -= 1
                gone = np.cumsum(change[:-1]) > 0 if c < 2 else np.ones(len(x.words), bool)
                if gone.any():
                    kept = b" ".join(w for w, g in zip(x.words, gone, strict=True) if not g)
                    rows.append((u, int(gone.sum()), kept.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["uid", "n_removed", "kept"])

    return given.mapInPandas(cover, "uid binary, n_removed long, kept string")


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """The documents with all their columns, their text without the words of repeated windows.

    A text that loses nothing stays as it is, blanks included; in others the
    kept words are joined by one space. Null texts stay null.
    """
    uid = key_of("_text")
    given = docs.select(F.col("text").alias("_text")).filter("_text is not null").select(uid.alias("uid"), "_text")
    lost = stored(kept_texts(given, window).select(F.col("uid").alias("_cl_uid"), F.col("kept").alias("_cl_kept")))
    keyed = with_may_be_in(
        docs.withColumn("_cl_key", key_of("text")), "_cl_key", lost.select(F.col("_cl_uid").alias("_cl_key")), "_cl_may"
    ).withColumn("_cl_may", F.col("text").isNotNull() & F.col("_cl_may"))
    changed = [F.coalesce("_cl_kept", "text").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    doubtful = keyed.filter("_cl_may").join(lost, F.col("_cl_key") == F.col("_cl_uid"), "left").select(*changed)
    return keyed.filter("not _cl_may").select(*docs.columns).unionByName(doubtful)


def removed_words(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Words end at the six ASCII blanks and stay unchanged. A word goes if it lies
    in a run of `window` words that also starts elsewhere, in the same document
    or in another; rows that repeat a text are other documents. Null, empty and
    short texts lose nothing. The digest is that of the kept words joined by one
    space. Ids play no part, so they may be null or repeated.
    """
    named = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    uid = key_of("_text")
    lost = kept_texts(named.filter("_text is not null").select(uid.alias("uid"), "_text"), window)
    lost = stored(lost.select("uid", "n_removed", F.sha2("kept", 256).alias("sha")))
    # only what isn't one space already is rewritten, so the words are found by the spaces between them
    plain = F.trim(F.regexp_replace(F.coalesce("_text", F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))
    spaces = F.length("_plain") - F.length(F.replace("_plain", F.lit(" "), F.lit("")))
    base = named.withColumn("_plain", plain).select(
        "_id", F.when(F.col("_text").isNotNull(), uid).alias("uid"),
        F.when(F.col("_plain") == "", 0).otherwise(spaces + 1).cast("long").alias("n_words"),
        F.sha2("_plain", 256).alias("whole"),
    )
    return base.join(lost, "uid", "left").select(
        F.col("_id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


OP6_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
twice AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS p FROM windows SEMI JOIN twice USING (g) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(p, i)) END, ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone USING (r)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6_substring_dedup(spark, sf):
    return removed_words(table(spark, sf, "documents"), window=35)
