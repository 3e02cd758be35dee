"""Vector codes by product quantization; entries are refined with ball k-means, exactly, in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import dropped, query, stored, table

PARTS, ENTRIES, ROUNDS = 4, 256, 4
LARGEST = 1 << 24  # integer components lie between this and its negative, so that squares and sums fit 64 bits
BLOCK = 512  # parts whose ring's distances are worked out at once


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to the rows of c, exactly."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:  # then doubles hold every sum
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - c[None, :, j]) ** 2
    return out


def ceil_root(n: int) -> int:
    root = int(np.sqrt(float(n)))
    while root * root < n:
        root += 1
    return root


class Book:
    """Entries of one part, with what tells which of them a part near one entry may be nearest to.

    An entry's ball holds the parts assigned to it before. `radius` bounds the
    distance of its centre from each of them. An entry j is a neighbour of entry
    c if half the way between them is no longer than c's radius: others can't
    have a part of the ball. `near` lists the neighbours of each entry, nearest
    first, the entry itself among them, and `way` their squared distances.
    """

    def __init__(self, entries: np.ndarray, radius: np.ndarray | None) -> None:
        self.entries = entries
        self.near: list[np.ndarray] | None = None
        if radius is None:
            return
        ways = squared(entries, entries)
        order = np.argsort(ways, axis=1, kind="stable")
        self.near, self.way = [], []
        for c, r in enumerate(radius.tolist()):
            way = ways[c][order[c]]
            n = int(np.searchsorted(way, 4 * r * r, side="right"))
            self.near.append(order[c][:n])
            self.way.append(way[:n])

    def assigned(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry of every row, ties to the lower index; squared distances; how many were worked out.

        A row at distance d of its own entry can only be nearer, or as near, to
        entries within 2d of that. In the stable core of a ball there is none, and
        the row stays. The others lie in rings, by how many neighbours are within
        2d, and meet just those.
        """
        if self.near is None:  # no balls yet
            best, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for a in range(0, len(x), BLOCK):
                d = squared(x[a : a + BLOCK], self.entries)
                best[a : a + BLOCK] = d.argmin(1)
                distance[a : a + BLOCK] = d.min(1)
            return best, distance, len(x) * len(self.entries)
        best = own.copy()
        distance = ((x - self.entries[own]) ** 2).sum(1)
        work = len(x)
        order = np.argsort(own, kind="stable")
        ends = np.flatnonzero(np.diff(own[order])) + 1
        for rows in np.split(order, ends):
            if not len(rows):
                continue
            c = own[rows[0]]
            ring = np.searchsorted(self.way[c], 4 * distance[rows], side="right")
            outer = rows[ring > 1][np.argsort(ring[ring > 1], kind="stable")]
            ring = np.sort(ring[ring > 1])
            for a in range(0, len(outer), BLOCK):
                some = outer[a : a + BLOCK]
                candidates = np.sort(self.near[c][: ring[min(a + BLOCK, len(ring)) - 1]])
                d = squared(x[some], self.entries[candidates])
                best[some] = candidates[d.argmin(1)]
                distance[some] = d.min(1)
                work += d.size
        return best, distance, work


def bounds(width: int) -> list[tuple[int, int]]:
    """Where the parts begin and end."""
    cuts = [p * width // PARTS for p in range(PARTS + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def integers(rows: DataFrame) -> DataFrame:
    """vec_id, label, width, x: integer components, four bytes each, of the vectors without null or non-finite ones."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    v = F.transform("embedding", lambda c: c.cast("double"))
    given = rows.select("vec_id", "label", v.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(fine(c), F.lit(False))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            ends = v.offsets.to_numpy() - v.offsets[0].as_py()
            x = np.floor(1024 * v.flatten().to_numpy(zero_copy_only=False))
            x = np.clip(x, -LARGEST, LARGEST).astype("<i4")
            packed = pa.Array.from_buffers(
                pa.binary(), len(b), [None, pa.py_buffer((ends * 4).astype("<i4")), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(np.diff(ends), pa.int32()), packed],
                ["vec_id", "label", "width", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.select("vec_id", "label").schema.fields}
    return given.mapInArrow(pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, width int, x binary")


def numbers(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """Rows of a binary column, all of one length, as numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.int64)


def assigned(rows: DataFrame, books: list[Book], width: int) -> DataFrame:
    """rows(vec_id, label, x, code) with the entries that are nearest now as code, a byte for each part, and error."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("vec_id", "label").schema.fields)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = numbers(b.column("x"), width, "<i4"), numbers(b.column("code"), PARTS, "u1")
            far = np.zeros((len(b), PARTS), np.int64)
            for p, (a, z) in enumerate(bounds(width)):
                own[:, p], far[:, p], _ = shared.value[p].assigned(x[:, a:z], own[:, p])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("x"),
                 pa.array([r.tobytes() for r in own.astype(np.uint8)], pa.binary()), pa.array(far.sum(1))],
                ["vec_id", "label", "x", "code", "error"])

    return rows.select("vec_id", "label", "x", "code").mapInArrow(
        assign, f"{kinds}, x binary, code binary, error long")


def summed(rows: DataFrame, books: list[Book], width: int) -> list[dict[int, tuple]]:
    """For each part, {entry: (count, largest squared distance to it, sums of its parts' components)}.

    Tasks add up what they hold first, so at most PARTS * ENTRIES rows of each are shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast([b.entries for b in books])
    widest = max(z - a for a, z in bounds(width))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((PARTS, ENTRIES), np.int64)
        far = np.zeros((PARTS, ENTRIES), np.int64)
        total = np.zeros((PARTS, ENTRIES, widest), np.int64)
        for b in batches:
            x, own = numbers(b.column("x"), width, "<i4"), numbers(b.column("code"), PARTS, "u1")
            for p, (a, z) in enumerate(bounds(width)):
                part, mine = x[:, a:z], own[:, p]
                count[p] += np.bincount(mine, minlength=ENTRIES)
                np.maximum.at(far[p], mine, ((part - shared.value[p][mine]) ** 2).sum(1))
                order = np.argsort(mine, kind="stable")
                first = np.flatnonzero(np.diff(mine[order], prepend=-1))
                total[p, mine[order][first], : z - a] += np.add.reduceat(part[order], first, axis=0)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(far[p, e]),
             pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "far", "s"])

    found = rows.select("x", "code").mapInArrow(add, "p int, e int, n long, far long, s array<long>").groupBy("p", "e").agg(
        F.sum("n"), F.max("far"), *[F.sum(F.get("s", F.lit(j))) for j in range(widest)]).collect()
    out: list[dict[int, tuple]] = [{} for _ in range(PARTS)]
    for p, e, n, far, *s in found:
        a, z = bounds(width)[p]
        out[p][e] = (n, far, np.array(s[: z - a], np.int64))
    return out


def moved(book: Book, told: dict[int, tuple]) -> Book:
    """The book after its entries moved to the means of their parts, rounded down.

    A part is no further from the moved entry than it was from the old one plus the way that moved.
    """
    entries, radius = book.entries.copy(), np.zeros(len(book.entries), np.int64)
    for e, (n, far, s) in told.items():
        entries[e] = s // n
        radius[e] = ceil_root(far) + ceil_root(int(((entries[e] - book.entries[e]) ** 2).sum()))
    return Book(entries, radius)


def coded(rows: DataFrame) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    A component x becomes floor(1024 * x); beyond 2**24 either way it counts as
    that. A vector is cut into PARTS parts of equal length, or, where its width is
    no multiple, part p begins at p * width div PARTS. Vectors that are null or
    hold null or non-finite components are dropped; zero vectors and empty ones
    are kept, and so is every row of an id that repeats or is null. Vectors of
    each width have books of their own. Books start from the first ENTRIES rows
    by id, null ids last, then by content; fewer rows make smaller books. In each
    of ROUNDS rounds all parts are assigned to their nearest entry, ties to the
    lower index, and entries with parts move to their means, rounded down.

    Parts are assigned exactly, by ball k-means (`Book`). Rows keep their codes
    from round to round in a stored table; the driver holds the books and sums
    of fixed size.
    """
    spark = rows.sparkSession
    base = stored(integers(rows))
    # a row for each width, not for each vector
    widths = [r["width"] for r in base.select("width").distinct().orderBy("width").collect()]
    kind = base.schema["vec_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    for width in widths:
        mine = base.filter(F.col("width") == width).drop("width")
        seeds = mine.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").collect()
        first = np.stack([np.frombuffer(r["x"], "<i4") for r in seeds]).astype(np.int64)
        books = [Book(first[:, a:z], None) for a, z in bounds(width)]
        now = mine.withColumn("code", F.lit(bytes(PARTS)))
        held = None
        for _ in range(ROUNDS):
            after = stored(assigned(now, books, width).drop("error"))
            if held is not None:
                dropped(held)
            now = held = after
            books = [moved(b, told) for b, told in zip(books, summed(now, books, width), strict=True)]
        done = stored(assigned(now, books, width).drop("x"))
        dropped(held)
        digest = hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()
        sums = done.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
        out = out.unionByName(done.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
            "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
            F.lit(digest).alias("codebooks_sha256")))
    return out


def _sql() -> str:
    steps = ["""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, x, list_inner_product(x, x) AS xx
  FROM (SELECT r, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) AS t(p))),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x, xx FROM parts WHERE r <= 256)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, p, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d
  FROM (SELECT a.r, a.p, b.e, a.xx - 2 * list_inner_product(a.x, b.x) + b.xx AS d FROM parts a JOIN b{i} b USING (p)) GROUP BY r, p)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} AS (
  SELECT p, e, list(m ORDER BY j) AS x
  FROM (SELECT p, e, j, floor(sum(c) / count(*)) AS m
    FROM (SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS j FROM a{i} JOIN parts USING (r, p)) GROUP BY p, e, j) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (
  SELECT p, e, x, list_inner_product(x, x) AS xx FROM (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, e)))""")
    steps.append(f"""
rows AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY p, e)) AS s FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM kept JOIN rows USING (r), books""")
    return "WITH" + ",".join(steps)


OP12_SQL = _sql()


@query("op12_vector_codes", OP12_SQL)
def op12_vector_codes(spark, sf):
    return coded(table(spark, sf, "embeddings"))
