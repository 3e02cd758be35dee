"""Ranked lexical search: term at a time, rarest first, with a limit on accumulators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import bits_set, dropped, query, sieve, stored, table

BITS = 24  # of the bitmap that keeps terms of no item out of the postings
# Terms are taken in blocks, rarest first: block b holds the terms in at most N / 4**(BLOCKS - 1 - b) documents.
BLOCKS = 5
BATCH = 200_000  # postings handed over at once
KNOWN = 1_000_000  # terms a task remembers having looked up

# Letters A-Z become small, other ASCII characters than digits and letters separate.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of digits, letters A-Z in small, and all characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item, item_id, term, q (how often): one row per term of an item. Each row of `items` is an item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (item, i, t, q)
                for item, i, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)
                for t, q in Counter(terms_of(text)).items()
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                ["item", "item_id", "term", "q"])

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text")
    return numbered.mapInArrow(split, "item long, item_id long, term binary, q long")


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """row, doc_id, n, term, tf: the terms of whole texts that may be `wanted` (term), by a bitmap of fixed size.

    A row without a term says how many documents with terms (tf) and terms (n)
    a task has seen. Rows number the documents, so that ids may be null or repeated.
    """
    place = F.pmod(F.xxhash64("term"), F.lit(1 << BITS))
    shared = docs.sparkSession.sparkContext.broadcast(bits_set(wanted.select(place.alias("p")), BITS))
    names, kinds = ["row", "doc_id", "n", "term", "tf"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, known = shared.value.view(np.uint64), {}
        documents = total = 0

        def is_wanted(term: bytes) -> bool:
            p = xxhash.xxh64_intdigest(term, seed=42) & ((1 << BITS) - 1)
            return bool(int(bitmap[p >> 6]) >> (p & 63) & 1)

        def told(rows: list, terms: list, counts: list) -> pa.RecordBatch:
            each = [len(rows[k]) for k in range(3)]
            assert each[0] == each[1] == each[2] == len(lengths)
            repeated = [pa.array(c, k).take(pa.array(np.repeat(np.arange(len(lengths)), lengths)))
                        for c, k in zip(rows, kinds, strict=False)]
            return pa.RecordBatch.from_arrays([*repeated, pa.array(terms, kinds[3]), pa.array(counts, kinds[4])], names)

        rows, lengths, terms, counts = ([], [], []), [], [], []
        for b in batches:
            for row, i, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                documents, total, before = documents + 1, total + len(words), len(terms)
                for t, c in Counter(words).items():
                    keep = known.get(t)
                    if keep is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        keep = known[t] = is_wanted(t)
                    if keep:
                        terms.append(t)
                        counts.append(c)
                for column, x in zip(rows, (row, i, len(words)), strict=True):
                    column.append(x)
                lengths.append(len(terms) - before)
                if len(terms) >= BATCH:
                    yield told(rows, terms, counts)
                    rows, lengths, terms, counts = ([], [], []), [], [], []
        if lengths:
            yield told(rows, terms, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in zip((None, None, total, None, documents), kinds, strict=True)], names)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return numbered.mapInArrow(build, "row long, doc_id long, n long, term binary, tf long")


def best_of(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows of every item with their rank: by score, then id, null ids last."""
    order = Window.partitionBy("item").orderBy(F.desc("s"), F.asc_nulls_last("doc_id"), "row")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents that score highest for every item: item_id, rank (from 1), doc_id, score above 0.

    A term's weight and its effect in a document are integers, so the order of
    adding plays no part. Terms are taken rarest first, a block at a time. An
    accumulator is a document's partial score for an item. The k-th partial score
    of an item bounds its k-th final one from below; once the highest scores that
    the terms left can add stay below it, no document that is new to the item can
    be among the best, and no accumulator is created any more. Accumulators that
    can't reach it go; the others are updated exactly, with all terms.

    Each row of `docs` and of `items` counts as one, whether ids repeat or are
    null; ids only break ties, null ones last. Null and empty texts, and texts
    without terms, are no documents, and items of that kind have no rows.
    """
    spark = docs.sparkSession
    result = "item_id long, rank int, doc_id long, score long"
    asked = stored(item_terms(items))
    wanted = asked.select("term").distinct()
    found = stored(postings(docs, wanted))
    count, total = found.filter("term is null").agg(F.sum("tf"), F.sum("n")).first()
    if not total:
        return spark.createDataFrame([], result)
    # in 64-bit integers, as div is; the longest text's n times N must stay below 2**63 / 75
    m = F.expr(f"25 + ((75 * n * {count}L) div {total}L)")
    posted = found.filter("term is not null").withColumn("m", m).withColumn(
        "effect", F.expr("(1000000000L * tf) div (1000 * tf + 8 * m)"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * count + 2) / (2.0 * F.col("df") + 1))).cast("long")
    share = F.ceil(F.log(F.col("df") / float(count)) / float(np.log(4)))  # 0, or below by one for each quarter
    stats = (
        posted.groupBy("term").agg(F.count("*").alias("df"), F.max("effect").alias("most")).join(wanted, "term")
        .select("term", weight.alias("w"), "most", F.greatest(F.lit(0), share + (BLOCKS - 1)).cast("int").alias("block"))
    )
    stats = stored(stats)
    lists = stored(
        asked.join(stats, "term").select("item", "term", "block", (F.col("q") * F.col("w")).alias("w"), "most")
        .withColumn("most", F.col("w") * F.col("most"))
    )
    names = asked.select("item", "item_id").distinct()
    # read once to its end: each block then reads its own folder only
    dealt = stored(posted.join(stats.select("term", "block"), "term").select("row", "doc_id", "term", "effect", "block"), "block")
    dropped(found)

    scored = spark.createDataFrame([], "item long, row long, doc_id long, s long")
    state = lists.select("item").distinct().withColumns({"floor": F.lit(None).cast("long"), "open": F.lit(True)})
    state, made = stored(state), []
    for b in range(BLOCKS):
        here, part = lists.filter(F.col("block") == b).select("item", "term", "w"), dealt.filter(F.col("block") == b)
        part = part.select("row", "doc_id", "term", "effect")
        fresh = here.join(state.filter("open").select("item"), "item").join(part, "term").select(
            "item", "row", "doc_id", (F.col("w") * F.col("effect")).alias("s"))
        added = fresh
        if made:
            closed = scored.join(state.filter("not open").select("item"), "item").select("item", "row", "doc_id")
            if not closed.isEmpty():
                lines = sieve(part, "row", closed.select("row")).drop("doc_id")
                known = closed.join(here, "item").join(lines, ["row", "term"]).select(
                    "item", "row", "doc_id", (F.col("w") * F.col("effect")).alias("s"))
                added = fresh.union(known)
        sums = stored(scored.union(added).groupBy("item", "row", "doc_id").agg(F.sum("s").alias("s")))
        left = lists.filter(F.col("block") > b).groupBy("item").agg(F.sum("most").alias("left"))
        floor = best_of(sums, k).filter(F.col("rank") == k).select("item", F.col("s").alias("floor"))
        now = state.select("item", F.col("open").alias("was")).join(floor, "item", "left").join(left, "item", "left").select(
            "item", F.coalesce("left", F.lit(0)).alias("left"), "floor",
            (F.col("was") & F.coalesce(F.coalesce("left", F.lit(0)) >= F.col("floor"), F.lit(True))).alias("open"))
        now = stored(now)
        kept = stored(
            sums.join(now.select("item", "left", "floor"), "item")
            .filter(F.coalesce(F.col("s") + F.col("left") >= F.col("floor"), F.lit(True))).select("item", "row", "doc_id", "s"))
        for old in (sums, state, *made):
            dropped(old)
        scored, state, made = kept, now, [kept]
    return best_of(scored.filter("s > 0"), k).join(names, "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", F.col("s").alias("score"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
item AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
asked AS (SELECT i, any_value(item_id) AS item_id, term, count(*)::BIGINT AS q FROM (SELECT i, item_id, unnest(t) AS term FROM item) GROUP BY i, term),
post AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, totals GROUP BY term),
scores AS (
  SELECT a.i, p.r, any_value(a.item_id) AS item_id, any_value(p.doc_id) AS doc_id,
    sum(a.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * z.n_docs) // z.n_terms))))::BIGINT AS score
  FROM asked a JOIN post p USING (term) JOIN weights w USING (term), totals z GROUP BY a.i, p.r),
best AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= 10
"""


@query("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark, sf):
    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
