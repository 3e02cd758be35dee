"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, query, table

BUCKETS = 4096  # of the seeded order, within each pattern
# The flow runs on the driver over patterns and sources, not over documents.
# More patterns than this are refused.
MAX_PATTERNS = 200_000


def targets(sizes: dict, weights: dict, share: float, most: float) -> dict[object, float]:
    """What each source should give: `share` of all sizes by weight, at most `most` times its own size.

    What a source cannot take is shared again by weight among those below their
    limit, until none is above. If all reach their limits, that is the result.
    """
    left = share * sum(sizes.values())
    open_now, out = list(sizes), {}
    while open_now:
        whole = sum(weights[s] for s in open_now)
        full = [s for s in open_now if left * weights[s] / whole > most * sizes[s]]
        if not full:
            return out | {s: left * weights[s] / whole for s in open_now}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        open_now = [s for s in open_now if s not in out]
    return out


def flow(
    patterns: list[tuple[tuple, int]], quotas: dict[object, int], passes: int
) -> list[dict[object, int]]:
    """Tokens that every pattern gives each of its sources, at least cost; sources get their quotas if they can.

    patterns: (sources, tokens). The first pass over a pattern's tokens costs
    nothing and the p-th costs p - 1 a token, so costs are convex and tokens are
    repeated only where quotas need it, evenly over patterns. Solved by
    successive shortest paths, a level of cost at a time: each path takes the cheapest way
    from a pattern with room to a source with need, moving others' tokens aside.
    """
    order = sorted(range(len(patterns)), key=lambda i: (len(patterns[i][0]), str(patterns[i])))
    given: list[dict] = [dict.fromkeys(s, 0) for s, _ in patterns]
    need = dict(quotas)
    holders: dict[object, list[int]] = {s: [] for s in quotas}
    for i in order:
        for s in patterns[i][0]:
            holders[s].append(i)
    used = [0] * len(patterns)
    for level in range(1, passes + 1):  # all that is possible at this cost, before any of the next
        for i in order:  # straight paths
            room = level * patterns[i][1] - used[i]
            for s in patterns[i][0]:
                x = min(room, need[s])
                if x > 0:
                    given[i][s] += x
                    used[i] += x
                    need[s] -= x
                    room -= x
        for goal in sorted((s for s in need if need[s] > 0), key=str):
            while need[goal] > 0:  # longer ones: search back from the source in need
                came: dict[object, tuple[int, object]] = {goal: (-1, None)}
                heap, end = [(0, str(goal), goal)], None
                while heap and end is None:
                    d, _, s = heapq.heappop(heap)
                    for i in holders[s]:
                        if used[i] < level * patterns[i][1]:
                            end = (i, s)
                            break
                        for other, x in given[i].items():
                            if x > 0 and other not in came:
                                came[other] = (i, s)
                                heapq.heappush(heap, (d + 1, str(other), other))
                if end is None:
                    break
                i, s = end
                x, at = min(need[goal], level * patterns[i][1] - used[i]), s
                while at != goal:
                    j, nxt = came[at]
                    x, at = min(x, given[j][at]), nxt
                given[i][s] += x
                used[i] += x
                while s != goal:
                    j, nxt = came[s]
                    given[j][s] -= x
                    given[j][nxt] += x
                    s = nxt
                need[goal] -= x
    return given


def taken_words(
    rows: DataFrame, weights: list[float], share: float, most: int, seed: int
) -> tuple[DataFrame, dict, dict]:
    """Adds `taken` to rows(..., pattern: sorted array of sources, size, _told: hash of the text); also sizes and targets of the sources.

    A pattern's tokens are routed by `flow`. Each document of a pattern is then
    taken as often as whole passes go; what remains goes to documents in an
    order seeded by hash, the last of them in part. The order is cut into
    buckets whose sums find the place where it ends, so that only one bucket of
    a pattern is sorted, however large the pattern.
    """
    by_pattern = rows.groupBy("pattern").agg(F.sum("size").alias("tokens"))
    found = by_pattern.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of sources")
    patterns = [(tuple(r["pattern"]), r["tokens"]) for r in found]
    sizes: dict = {}
    for sources, tokens in patterns:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + tokens
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    sizes = {s: sizes[s] for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(tokens for _, tokens in patterns)
    aim = targets(sizes, weight, share * total / max(1, sum(sizes.values())), most)
    given = flow(patterns, {s: round(t) for s, t in aim.items()}, most)
    spark = rows.sparkSession
    plan = spark.createDataFrame(
        [(list(p), sum(g.values()) // t if t else 0, sum(g.values()) % t if t else 0)
         for (p, t), g in zip(patterns, given, strict=True)],
        "pattern array<string>, whole long, part long",
    ).withColumn("_p", F.xxhash64("pattern", F.size("pattern"))).drop("pattern")
    draw = F.xxhash64("_id", "_source", "size", "_told", F.lit(seed))
    drawn = rows.withColumns({
        "_p": F.xxhash64("pattern", F.size("pattern")), "draw": draw,
        "bucket": F.shiftrightunsigned(draw, 52).cast("int"),
    })
    sums = drawn.groupBy("_p", "bucket").agg(F.sum("size").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy("_p").orderBy("bucket")) - F.col("tokens")
    edges = sums.withColumn("before", before).join(F.broadcast(plan), "_p").filter(
        F.col("before") + F.col("tokens") > F.col("part")
    ).groupBy("_p").agg(F.min(F.struct("bucket", (F.col("part") - F.col("before")).alias("left"))).alias("edge"))
    plan = plan.join(edges, "_p", "left").select(
        "_p", "whole", F.coalesce("edge.bucket", F.lit(BUCKETS)).alias("edge"), F.coalesce("edge.left", F.lit(0)).alias("left")
    )
    # one row of each pattern, of which the driver has held all
    placed = drawn.join(F.broadcast(plan), "_p")
    running = F.sum("size").over(
        Window.partitionBy("_p").orderBy("draw", "_id", "_told").rowsBetween(Window.unboundedPreceding, -1)
    )
    clear = placed.filter("bucket <> edge").withColumn(
        "more", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)
    )
    at_edge = placed.filter("bucket = edge").withColumn("more", F.greatest(
        F.lit(0).cast("long"), F.least("size", F.col("left") - F.coalesce(running, F.lit(0)))))
    out = clear.unionByName(at_edge).withColumn("taken", F.col("size") * F.col("whole") + F.col("more"))
    return out, sizes, aim


def pattern_of(members: str | None) -> Column:
    """The sources that hold a document, each once and in order: those of the column `members`, by default its `source`.

    A document whose members are null or none is held by its source.
    """
    own = F.array("source")
    if members is None:
        return own
    given = F.array_sort(F.array_distinct(F.col(members).cast("array<string>")))
    return F.when(F.size(given) > 0, given).otherwise(own)


def sized(docs: DataFrame, members: str | None = None) -> DataFrame:
    """_id, _source, size (words of the text), pattern, _told (hash of the text), by which rows of one id differ."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), words.alias("size"),
        pattern_of(members).alias("pattern"), F.xxhash64("text").alias("_told"),
    )


def mixed(
    docs: DataFrame, weights: list[float], share: float = 1.5, most: int = 2, seed: int = 0, members: str | None = None
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target (its source's), taken.

    Sources are in code point order, null last, and get the weights in turn.
    `members` names a column with the array of sources that hold a document;
    without it each row is held by its `source` alone. A source's size counts
    all documents it holds; size and target are null for a `source` that holds
    none. Sizes count words of whole texts; null and empty texts have size 0 and
    are taken 0 words. Repeated rows are equals: they may be taken differently.
    The same rows and seed give the same mix. An empty table gives an empty
    result.
    """
    rows = sized(docs, members)
    out, sizes, aim = taken_words(rows, weights, share, most, seed)
    known = rows.sparkSession.createDataFrame(
        [(s, int(n), float(aim[s])) for s, n in sizes.items()], "_s string, source_size long, target double"
    )
    # one row per source, of which the driver has held all
    return out.join(F.broadcast(known), F.col("_source").eqNullSafe(F.col("_s")), "left").select(
        F.col("_id").alias("doc_id"), "size", F.col("_source").alias("source"), "source_size", "target", "taken"
    )


def mixed_documents(
    docs: DataFrame, weights: list[float], share: float = 1.5, most: int = 2, seed: int = 0, members: str | None = None
) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each time that a document is taken.

    `members` is as for `mixed`.
    A document taken in part has the words taken, joined by one space.
    Documents that are taken no word of are left out; a document without words
    has nothing to take and stays once. No text is shuffled, but for the few
    documents among which a pattern's order ends.
    """
    rows = docs.withColumn("_all", F.struct(*docs.columns)).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        pattern_of(members).alias("pattern"), F.xxhash64("_all.text").alias("_told"), "_all",
    )
    out, _, _ = taken_words(rows, weights, share, most, seed)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    words = F.slice(F.regexp_extract_all("_all.text", F.lit(f"({WORD})")), F.lit(1), F.col("part"))
    cut = F.when(F.col("part") > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    texts = F.concat(F.array_repeat("_all.text", F.col("whole")), cut)
    return out.withColumn("whole", whole).withColumn("part", part).withColumn("_text", F.explode(texts)).select(
        *[F.col("_text").alias(c) if c == "text" else F.col(f"_all.{c}") for c in docs.columns]
    )


@query("op5_source_mixing")
def op5_source_mixing(spark, sf):
    return mixed(table(spark, sf, "documents"), weights=[3, 1, 2])
