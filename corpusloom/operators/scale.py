"""Building blocks that keep one hot key from becoming one hot task."""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import let

SKETCH = 40  # sampled keys for each piece of a sketch
PIECES = 256  # of the rows among which a page is looked for
MOST_PIECES = 4_096  # of the rows that are numbered


def first_by(df: DataFrame, keys: list[str], order: Column, last: bool = False) -> DataFrame:
    """One row per key, the first by a unique order (or the last).

    An aggregate, not a window: every task keeps one row per key before the
    shuffle, so a hot key costs one row per task.
    """
    rest = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    pick = F.max_by(rest, order) if last else F.min_by(rest, order)
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def lookup_join(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join to a side with one row per key; how is inner, left, left_semi or left_anti.

    A plain join: adaptive execution splits the partitions of hot keys, which
    needs `spark.sql.adaptive.skewJoin.enabled`, and broadcasts only what it has
    measured. Rows with a null key match nothing, so a salt spreads them.
    """
    loose = F.lit(False)
    for k in on:
        loose = loose | F.col(k).isNull()
    simple = [f.name for f in fact.schema.fields if not isinstance(f.dataType, T.MapType)]
    salted = fact.withColumn("_salt", F.when(loose, F.xxhash64(*simple)).otherwise(F.lit(0)))
    joined = salted.join(dim.withColumn("_salt", F.lit(0).cast("bigint")), [*on, "_salt"], how)
    values = [] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c not in on]
    return joined.select(*fact.columns, *values)


def split_by_bits(rows: DataFrame, keys: list[str], wanted: DataFrame, bits: int = 22) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys may be among `wanted`, rows whose keys surely aren't): spares the second a shuffle by a join.

    A bitmap of fixed size is all that is broadcast, at most 2**bits / 64 rows.
    The more keys are wanted, the more others are let through, so a join must
    follow over the first part.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    held = wanted.groupBy(word.alias("_w")).agg(F.bit_or(bit).alias("_b"))
    marked = rows.withColumn("_w", word).join(F.broadcast(held), "_w", "left")
    may = F.coalesce(F.col("_b").bitwiseAND(bit) != 0, F.lit(False))
    return marked.filter(may).select(*rows.columns), marked.filter(~may).select(*rows.columns)


# --- order statistics ----------------------------------------------------------


@dataclass(frozen=True)
class Key:
    """A column of an order and its direction. Null is the smallest value, as in Spark's own orders."""

    column: Column
    descending: bool = False

    def sort(self) -> Column:
        return self.column.desc() if self.descending else self.column.asc()

    def before(self, cut: Column) -> Column:
        """Whether a row stands before a cut value."""
        less = (self.column > cut) | (cut.isNull() & self.column.isNotNull()) if self.descending else (
            (self.column < cut) | (self.column.isNull() & cut.isNotNull()))
        return F.coalesce(less, F.lit(False))


def up(column: str | Column) -> Key:
    return Key(F.col(column) if isinstance(column, str) else column)


def down(column: str | Column) -> Key:
    return Key(F.col(column) if isinstance(column, str) else column, True)


def keys_of(order: list[Key | str | Column]) -> list[Key]:
    """The keys of an order; names and plain columns ascend."""
    return [k if isinstance(k, Key) else up(k) for k in order]


def _cuts(rows: DataFrame, order: list[Key], total: int, pieces: int) -> list[tuple]:
    """Key values that cut the rows into about so many pieces of one size, by a sample of bounded size."""
    fraction = min(1.0, SKETCH * pieces / total)
    sample = rows.select(*[k.column.alias(f"k{i}") for i, k in enumerate(order)]).sample(fraction, 7)
    names = [Key(F.col(f"k{i}"), k.descending).sort() for i, k in enumerate(order)]
    found = [tuple(r) for r in sample.orderBy(*names).collect()]
    return list(dict.fromkeys(found[i * len(found) // pieces] for i in range(1, pieces))) if found else []


def _piece(rows: DataFrame, order: list[Key], cuts: list[tuple]) -> Column:
    """How many of the cuts a row doesn't stand before: the number of its piece."""
    if not cuts:
        return F.lit(0)
    kinds = [rows.select(k.column.alias("k")).schema["k"].dataType for k in order]

    def literal(given: list[tuple]) -> Column:
        return F.array(*[
            F.struct(*[F.lit(v).cast(kind).alias(f"k{i}") for i, (v, kind) in enumerate(zip(cut, kinds, strict=True))])
            for cut in given
        ])

    def reached(cut: Column) -> Column:
        out = F.lit(True)
        for i, k in reversed(list(enumerate(order))):
            value = cut[f"k{i}"]
            out = F.when(k.before(value), False).when(k.column.eqNullSafe(value), out).otherwise(True)
        return out

    def count(given: Column) -> Column:
        return F.size(F.filter(given, reached))

    # the cuts ascend, so every so many of them tell which stretch is to be looked at
    step = isqrt(len(cuts))
    heads = cuts[step - 1 :: step]
    return let(
        count(literal(heads)),
        lambda n: n * step + count(F.slice(literal(cuts), n * step + 1, F.lit(step))),
    )


def nth_rows(rows: DataFrame, order: list[Key | str | Column], offset: int, limit: int, small: int = 100_000) -> DataFrame:
    """The rows at places `offset` + 1 to `offset` + `limit` of an order that ends in a unique column, in order.

    The rows are cut into pieces by a sketch of the order's key, and counts per
    piece find the ones that hold the places asked for. These are cut again until
    they hold no more than `small` rows besides the ones asked for, which are
    sorted. Rows of other pieces are only counted, so nothing is shuffled but
    counts, whatever the offset. The rows must come out alike each time they are read.
    """
    order = keys_of(order)
    sort = [k.sort() for k in order]
    total = rows.count()
    while total > small + limit and offset < total:
        cuts = _cuts(rows, order, total, PIECES)
        piece = _piece(rows, order, cuts)
        counts = dict(rows.groupBy(piece.alias("p")).count().collect())
        spans, seen = [], 0
        for p in sorted(counts):
            spans.append((p, seen, seen + counts[p]))
            seen += counts[p]
        held = [s for s in spans if s[2] > offset and s[1] < offset + limit]
        left = held[-1][2] - held[0][1]
        if left == total:  # the sketch tells no two of them apart, or all of them are asked for
            break
        rows, offset, total = rows.filter(piece.between(held[0][0], held[-1][0])), offset - held[0][1], left
    return rows.orderBy(*sort).offset(offset).limit(limit)


def numbered(
    df: DataFrame, keys: list[str], order: list[Key | str | Column], weight: Column | None = None,
    piece_rows: int = 1_000_000,
) -> DataFrame:
    """Adds `n`, the 1-based position within `keys`, and `before`, the weight that precedes it.

    Rows are dealt to pieces by a sketch of (keys, order), so a hot key spans
    many tasks and each numbers its own stretch. The piece of a row depends on
    its own values alone, so the rows are neither checkpointed nor placed twice.
    Only a key that continues from an earlier piece needs an offset, and a piece
    starts inside at most one key, so the offsets number fewer than the pieces
    and may be broadcast. `order` must be unique within `keys`.
    """
    order = keys_of(order)
    by = keys or ["_all"]
    weighed = df.withColumn("_all", F.lit(0)).withColumn("_w", (F.lit(0) if weight is None else weight).cast("bigint"))
    total = df.count()
    pieces = max(1, min(MOST_PIECES, total // piece_rows))
    whole = [*[up(k) for k in by], *order]
    cuts = _cuts(weighed, whole, total, pieces) if pieces > 1 else []
    placed = weighed.withColumn("_pid", _piece(weighed, whole, cuts))
    local = Window.partitionBy("_pid", *by).orderBy(*[k.sort() for k in order])
    rows = placed.withColumn("_n", F.row_number().over(local).cast("bigint")).withColumn(
        "_b", F.sum("_w").over(local.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_w")
    )
    if not cuts:
        return rows.select(*df.columns, F.col("_n").alias("n"), F.col("_b").alias("before"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_pid", *by)
        .agg(F.count("*").alias("_c"), F.sum("_w").alias("_cw"))
        .select(
            F.col("_pid").alias("_opid"),
            *[F.col(k).alias(f"_o_{k}") for k in by],
            F.sum("_c").over(earlier).alias("_on"),
            F.sum("_cw").over(earlier).alias("_ow"),
        )
        .filter("_on > 0")
    )
    same = F.col("_pid") == F.col("_opid")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return rows.join(F.broadcast(offsets), same, "left").select(
        *df.columns,
        (F.col("_n") + F.coalesce("_on", F.lit(0))).alias("n"),
        (F.col("_b") + F.coalesce("_ow", F.lit(0))).alias("before"),
    )
