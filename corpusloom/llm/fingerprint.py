"""Document fingerprints by winnowing, in column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE, query, stored, table

K, W = 5, 16  # words of a k-gram; k-grams of a window
# Positions are packed below the hash's upper bits to find the rightmost minimum.
PLACE_BITS = 26


def winnowed(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Adds `out`: the chosen (pos, hash) of a text column, in order of position.

    The hash of every k consecutive words (of the whole text if it has fewer),
    and of every w consecutive hashes the least, of equal ones the rightmost.
    Hashes are compared by their upper 64 - PLACE_BITS bits, with the position,
    counted down, below them, so that one minimum of longs gives the place.
    Minima of w elements come from minima of fewer in log2(w) passes; elements
    are reached by index, as cutting windows out would copy the array each time.
    Whatever two texts share of at least w + k - 1 words, both choose a k-gram in it.
    """
    span = 1 << PLACE_BITS
    step = df.withColumn("_w", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda x: x != ""))
    n = F.size("_w")
    grams = F.sequence(F.lit(0), F.greatest(n - k, F.lit(0)))
    step = step.withColumn("_h", F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(grams, lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)]))))
    step = step.withColumn("_p", F.transform(
        "_h", lambda h, i: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS) + (F.lit(span - 1) - i % span)))
    size, at = 1, "_p"
    while size < w:
        more = min(size, w - size)
        step = step.withColumn(f"{at}m", F.transform(at, lambda x, i: F.least(x, F.get(at, i + more))))
        size, at = size + more, f"{at}m"
    windows = F.slice(at, 1, F.greatest(F.size("_h") - w + 1, F.least(F.size("_h"), F.lit(1))))
    # the place within a stretch of 2**PLACE_BITS, moved to the stretch that the window is in
    place = F.transform(windows, lambda p, i: (
        i + F.pmod(F.lit(span - 1) - p.bitwiseAND(F.lit(span - 1)) - i, F.lit(span))).cast("int"))
    step = step.withColumn("_at", F.array_distinct(place))
    return step.withColumn(
        out, F.transform("_at", lambda p: F.struct(p.alias("pos"), F.get("_h", p).alias("hash")))
    ).select(*df.columns, out)


def as_text(prints: Column) -> Column:
    """`pos:hash` in hexadecimal, joined by blanks; empty for a text without words."""
    return F.array_join(F.transform(prints, lambda x: F.concat(F.lower(F.hex(x["pos"])), F.lit(":"), F.lower(F.hex(x["hash"])))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the hashes of two fingerprints, as sets; 1 if both are empty."""
    both, whole = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(whole == 0, F.lit(1.0)).otherwise(both / whole)


def neighbours(keys: DataFrame) -> DataFrame:
    """Adds the key before each (before_id, before_tie, before_chars), the first's being the last.

    Input: id, tie, n_chars, c; (id, tie) unique. Keys are dealt by ranges of
    their order and stored, so that both uses of a range agree; within a range a
    window looks one row back, and a range's first row gets the last row of the
    range before it, of which there is one for each range.
    """
    placed = stored(keys.repartitionByRange("id", "tie").withColumn("part", F.spark_partition_id()))
    me = F.struct("id", "tie", "n_chars")
    ends = placed.groupBy("part").agg(F.max(me).alias("end"))
    parts = ends.withColumn("_all", F.lit(0))
    # as many rows as ranges
    turn = Window.partitionBy("_all").orderBy("part")
    whole = turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = parts.select("part", F.coalesce(F.lag("end").over(turn), F.last("end").over(whole)).alias("link"))
    local = F.lag(me).over(Window.partitionBy("part").orderBy("id", "tie"))
    return placed.withColumn("local", local).join(F.broadcast(links), "part").select(
        "id", "tie", "c", F.coalesce("local", "link").alias("before")
    )


def edited_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends in the beginning of the next document's text instead
    of its own last half, in code points. Next is by ascending id, nulls first,
    rows of one id by their text's hash; after the last comes the first, so a
    single document is its own next. The least long counts as a null id. A null text is an empty one: its
    fingerprint is empty, and two empty fingerprints have likeness 1. Equal rows
    follow each other. The texts move once whole and once by half.
    """
    # plain keys without nulls, so that the joins and the window share one partitioning
    text = F.coalesce("text", F.lit(""))
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), text.alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    keys = named.groupBy("id", "tie").agg(F.first(F.length("text")).alias("n_chars"), F.count("*").alias("c"))
    order = stored(neighbours(keys))
    here = order.select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "c", "before")
    rows = named.join(here, (F.col("id") == F.col("_id")) & (F.col("tie") == F.col("_tie"))).drop("_id", "_tie")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "tie").orderBy("c")))

    first = rows.filter("nth = 1").select(
        F.col("before.id").alias("to_id"), F.col("before.tie").alias("to_tie"),
        F.expr("substring(text, 1, cast(floor(before.n_chars / 2) as int))").alias("piece"), "text",
    )
    given = winnowed(first, "text", "_f", k, w).select("to_id", "to_tie", "piece", F.col("_f.hash").alias("next_hashes"))
    own = winnowed(rows.withColumn("n_chars", F.length("text")), "text", "fp", k, w)
    both = own.join(given, (F.col("id") == F.col("to_id")) & (F.col("tie") == F.col("to_tie")), "left")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    last = F.col("nth") == F.col("c")
    piece = F.when(last, F.col("piece")).otherwise(F.substring("text", F.lit(1), half))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), piece)
    out = winnowed(both.withColumn("edited", edited), "edited", "efp", k, w)
    mine = F.col("fp.hash")
    return out.select(
        F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("efp")).alias("edited_fingerprint"), likeness(mine, F.col("efp.hash")).alias("near_edited"),
        likeness(mine, F.when(last, F.col("next_hashes")).otherwise(mine)).alias("near_next"),
    )


@query("op3_winnowing")
def op3_winnowing(spark, sf):
    return edited_fingerprints(table(spark, sf, "documents"))
