"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import columns_of, held_out, mix, query, table

# Bound of the sample learnt from: rows of each language.
SAMPLE_ROWS = 5_000
# An n-gram is in a language's filter if it makes up this share of the n-grams
# of its length; so a filter holds at most 2 / SHARE n-grams.
SHARE = 2e-5
SIZES = (3, 4)
PORTION = 1 << 19  # code points handled at once

_NO_LETTER = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def gram_hashes(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hashes of all n-grams) of the lower-cased letters, words set apart by one space, in portions."""
    letters = f" {_NO_LETTER.sub(' ', text.lower()).strip()} "
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for a in range(0, max(1, len(points) - 2), PORTION):
        c = points[a : a + PORTION + max(SIZES) - 1]
        three = c[:-2] | (c[1:-1] << np.uint64(21)) | (c[2:] << np.uint64(42))
        yield 3, mix(three[:PORTION])
        if len(c) > 3:
            yield 4, mix(mix(three[:-1]) + c[3:])[:PORTION]


class LanguageFilters:
    """One Bloom filter a language, stored across: row r holds bit r of every filter.

    ANDing the rows that an n-gram hashes to gives the mask of all languages
    that contain it, however many there are.
    """

    def __init__(self, grams: dict[str, np.ndarray], rows: dict[str, int]) -> None:
        self.langs = sorted(grams)
        most = max((len(g) for g in grams.values()), default=0)
        self.mask = np.uint64((1 << max(10, int(8 * most).bit_length())) - 1)
        self.planes = -(-len(self.langs) // 8)
        self.table = np.zeros((int(self.mask) + 1, self.planes), np.uint8)
        for i, lang in enumerate(self.langs):
            for at in self.rows_of(grams[lang]):
                self.table[at, i // 8] |= np.uint8(1 << (i % 8))
        fill = np.array([((self.table[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(self.langs))])
        self.false = fill**2
        self.prior = np.array([rows[x] for x in self.langs], float)
        self.bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(float)

    def rows_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (h & self.mask).astype(np.int64), ((h >> np.uint64(32)) & self.mask).astype(np.int64)

    def counts(self, text: str) -> np.ndarray:
        """N-grams of the text in each language, corrected for what a filter says wrongly."""
        seen, total = np.zeros(8 * self.planes), 0
        for _, h in gram_hashes(text):
            a, b = self.rows_of(h)
            total += len(h)
            for plane in range(self.planes):
                found = self.table[a, plane] & self.table[b, plane]
                seen[8 * plane : 8 * plane + 8] += np.bincount(found, minlength=256) @ self.bits
        c = seen[: len(self.langs)]
        return np.clip((c - total * self.false) / (1 - self.false), 0, total)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        c = self.counts(text)
        if not c.any():
            return self.langs[int(self.prior.argmax())], 0.0
        top = np.flatnonzero(c == c.max())
        best = top[self.prior[top].argmax()]
        return self.langs[int(best)], float(c[best] / c.sum())


def learned(docs: DataFrame) -> LanguageFilters:
    """Filters learnt from text and lang of rows outside the held-out quarter.

    At most about SAMPLE_ROWS rows of each language, chosen by a hash of the id.
    The n-grams are counted in Spark; the driver gets those of the filters only,
    at most 2 / SHARE for each language.
    """
    known = docs.select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("text").alias("_text")
    ).filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id")))
    rows = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}
    if not rows:
        return LanguageFilters({}, {})
    share = F.create_map(*[F.lit(x) for k, n in rows.items() for x in (k, min(1.0, SAMPLE_ROWS / n))])
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000.0

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("_lang")["_text"]:
                for n in SIZES:
                    got = [h for t in texts if has_letter(t) for m, h in gram_hashes(t) if m == n]
                    if got:
                        h, c = np.unique(np.concatenate(got), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "n": n, "h": h.view(np.int64), "c": c})

    counted = (
        known.filter(draw < share[F.col("_lang")]).select("_lang", "_text")
        .mapInPandas(count, "lang string, n int, h long, c long")
        .groupBy("lang", "n", "h").agg(F.sum("c").alias("c"))
    )
    counted = counted.persist()
    totals = counted.groupBy("lang", "n").agg(F.sum("c").alias("total"))
    kept = counted.join(F.broadcast(totals), ["lang", "n"]).filter(F.col("c") >= SHARE * F.col("total"))
    found = kept.select("lang", "h").toPandas()
    counted.unpersist()
    grams = {x: g.to_numpy(np.int64).view(np.uint64) for x, g in found.groupby("lang")["h"]}
    return LanguageFilters(grams, rows)


def identified(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    `und` with score 0 if the text is null or has no letter, or if no language
    was learnt. Texts without any known n-gram get the commonest language with
    score 0; ties go to the language with more rows, then to the first by name.
    Whole texts are read. Repeated rows get the same answer.
    """
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = [filters.predict(t) for t in b["text"]]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "held_out": b["held_out"],
                "lang_pred": [x for x, _ in said], "score": [s for _, s in said],
            })

    kind = dict(docs.dtypes)["doc_id"]
    given = columns_of(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return given.mapInPandas(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


@query("op2_language_id")
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    return identified(docs, learned(docs))
