"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import query, stored, table

DIMS = 8  # of the projected space
CELL = 2_048  # rows of a cell of the tree
SAMPLE = 200_000  # rows that the tree is cut on; all rows are indexed
CONFIDENCE = 0.995  # that a nearer vector would have shown up by now
LEAF = 64
SALT = 8_192  # rows of a cell that one task holds


def chi_square(p: float, dims: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    half = dims // 2
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        x = (lo + hi) / 2
        upper = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(half))
        lo, hi = (x, hi) if 1 - upper < p else (lo, x)
    return hi


def projection(width: int, seed: int = 0) -> np.ndarray:
    """Gaussian, so 2-stable: a projected distance squared is the true one times a chi-square variable."""
    return np.random.default_rng(seed + width).normal(size=(width, DIMS))


class Cells:
    """A kd-tree's upper part: cut on a sample, its leaves are the cells that rows are dealt to."""

    def __init__(self, points: np.ndarray, cells: int) -> None:
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, value, left, right; axis -1: cell number
        self.lows: list[np.ndarray] = []
        self.highs: list[np.ndarray] = []
        everywhere = np.full(DIMS, np.inf)
        self._cut(points, max(1, cells), -everywhere, everywhere)
        self.boxes = np.stack(self.lows), np.stack(self.highs)

    def _cut(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, len(self.lows), 0))
        if cells > 1 and len(points) > 1:
            axis = int(np.ptp(points, axis=0).argmax())
            value = float(np.median(points[:, axis]))
            left = points[:, axis] < value
            if left.any() and not left.all():
                below, above = high.copy(), low.copy()
                below[axis] = above[axis] = value
                a = self._cut(points[left], cells // 2, low, below)
                b = self._cut(points[~left], cells - cells // 2, above, high)
                self.nodes[at] = (axis, value, a, b)
                return at
        self.nodes[at] = (-1, 0.0, len(self.lows), 0)
        self.lows.append(low)
        self.highs.append(high)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            axis, value, a, b = self.nodes[node]
            if axis < 0:
                out[rows] = a
            elif len(rows):
                left = points[rows, axis] < value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of every point to every cell's box."""
        low, high = self.boxes
        gap = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
        return (gap**2).sum(2)


class Tree:
    """A kd-tree over the projected points of one cell; yields leaves by growing distance."""

    def __init__(self, points: np.ndarray) -> None:
        self.leaves: list[np.ndarray] = []
        boxes = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            spread = np.ptp(points[rows], axis=0)
            if len(rows) <= LEAF or not spread.any():
                self.leaves.append(rows)
                boxes.append((points[rows].min(0), points[rows].max(0)))
                continue
            axis = int(spread.argmax())
            order = rows[np.argsort(points[rows, axis], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low, self.high = np.stack([a for a, _ in boxes]), np.stack([b for _, b in boxes])

    def by_distance(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = (np.maximum(np.maximum(self.low - q, q - self.high), 0) ** 2).sum(1)
        order = np.argsort(gap, kind="stable")
        return order, gap[order]


def search(points, vectors, ids, queries, query_points, query_ids, bounds, k: int, limit: float) -> list[tuple]:
    """(query_id, vec_id, distance squared): the k nearest that each query finds in one cell.

    Leaves come by growing projected distance d; all their vectors are
    verified. The search ends when d squared exceeds `limit` times the squared
    distance of the k-th nearest so far: a nearer vector would then, with the
    confidence that gives `limit`, have been projected nearer than d. `bounds`
    are k-th distances known from elsewhere.
    """
    tree, out = Tree(points), []
    for q, p, i, bound in zip(queries, query_points, query_ids, bounds, strict=True):
        best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
        order, gaps = tree.by_distance(p)
        at = 0
        while at < len(order):
            worst = bound
            if len(best_d) >= k:
                worst = min(worst, best_d[-1])
            if gaps[at] > limit * worst:
                break
            end = min(at + 4, len(order))
            rows = np.concatenate([tree.leaves[x] for x in order[at:end]])
            at = end
            rows = rows[ids[rows] != i]
            d = ((vectors[rows] - q) ** 2).sum(1)
            d, n = np.concatenate((best_d, d)), np.concatenate((best_i, ids[rows]))
            top = np.lexsort((n, d))[:k]
            best_d, best_i = d[top], n[top]
        out += [(i, int(n), float(d)) for n, d in zip(best_i, best_d, strict=True)]
    return out


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (doubles): without null ids or vectors, zero vectors, and null or non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.transform("embedding", lambda x: x.cast("double"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: F.coalesce(fine(x), F.lit(False))) & F.exists("v", lambda x: x != 0)
    )


def nearest(rows: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest found of every query: query_id, rank, vec_id, score (Euclidean distance).

    Queries are the rows whose id is divisible by `every`, candidates all others.
    The tree's cells are cut on a bounded sample, and every row is indexed. A
    query first searches its own cell, then every cell that its stopping test
    leaves open, each with the k-th distance known so far. Cells larger than a
    task should hold, as many equal vectors make, are dealt to several.
    Vectors that are null, zero or hold null or non-finite components take no
    part, and vectors of another width than a query's are no candidates of it.
    Rows that repeat id and vector count once. Of rows that share an id and
    differ, each is a candidate of the others' queries; a query's own id is none.
    Ties go to the smaller id.
    """
    spark = rows.sparkSession
    # equal rows are one candidate: they would take up the k places of a cell and its bound
    given = stored(usable(rows).distinct())
    counts = given.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("c")).collect()
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    @F.pandas_udf("array<double>")
    def projected(v: pd.Series) -> pd.Series:  # of the sample, the driver gets DIMS numbers a vector
        return pd.Series(list(np.stack(v.to_list()) @ projection(len(v.iloc[0]))))

    trees = {}
    for width, c in counts:
        share = min(1.0, SAMPLE / c)
        sample = given.filter(F.size("v") == width).filter(
            F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000).select(projected("v").alias("p")).toPandas()["p"]
        points = np.stack(sample.to_list()) if len(sample) else np.zeros((0, DIMS))
        trees[width] = Cells(points, -(-c // CELL))
    shared = spark.sparkContext.broadcast(trees)
    limit = chi_square(CONFIDENCE, DIMS)

    @F.pandas_udf("long")
    def cell_of(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        widths = v.map(len).to_numpy()
        for w in np.unique(widths):
            at = np.flatnonzero(widths == w)
            out[at] = shared.value[w].of(np.stack(v.iloc[at].to_list()) @ projection(w))
        return pd.Series(out)

    indexed = stored(given.withColumn("width", F.size("v")).withColumn("cell", cell_of("v")))
    sizes = indexed.groupBy("width", "cell").agg(F.ceil(F.count("*") / SALT).cast("int").alias("pieces"))
    sizes = stored(sizes)
    base = indexed.join(sizes, ["width", "cell"]).withColumn(
        "piece", F.pmod(F.xxhash64("vec_id", "v"), F.col("pieces")).cast("int")).drop("pieces")
    queries = indexed.filter(F.col("vec_id") % every == 0).select("vec_id", "width", "cell", "v")

    def run(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(asked):
            x, q = np.stack(candidates["v"].to_list()), np.stack(asked["v_q"].to_list())
            turn = projection(x.shape[1])
            found = search(x @ turn, x, candidates["vec_id"].to_numpy(), q, q @ turn,
                           asked["vec_id_q"].to_numpy(), asked["bound_q"].to_numpy(), k, limit)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "d"])

    def searched(asked: DataFrame) -> DataFrame:
        spread = asked.join(sizes, ["width", "cell"]).withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
        ).select(*[F.col(c).alias(f"{c}_q") for c in ("width", "cell", "piece", "vec_id", "v", "bound")])
        there = spread.groupBy("width_q", "cell_q", "piece_q")
        return base.groupBy("width", "cell", "piece").cogroup(there).applyInPandas(
            run, "query_id long, vec_id long, d double")

    def best(found: DataFrame) -> DataFrame:
        # the rank is limited before the shuffle, so a query has k rows from each task, not from each cell
        order = Window.partitionBy("query_id").orderBy("d", "vec_id")
        top = found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
        return top.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("d", "vec_id"))).alias("best"))

    first = stored(searched(queries.withColumn("bound", F.lit(float("inf")))))
    bound = best(first).select(
        F.col("query_id").alias("vec_id"),
        F.when(F.size("best") >= k, F.element_at("best", k)["d"]).otherwise(float("inf")).alias("bound"))
    known = queries.join(bound, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    @F.pandas_udf("array<long>")
    def still_open(v: pd.Series, cell: pd.Series, bound: pd.Series) -> pd.Series:
        out = []
        for x, c, b in zip(v, cell, bound, strict=True):
            gap = shared.value[len(x)].distances((x @ projection(len(x)))[None])[0]
            near = np.flatnonzero(gap <= limit * b)
            out.append(near[near != c])
        return pd.Series(out)

    more = known.withColumn("cell", F.explode(still_open("v", "cell", "bound")))
    both = first.unionByName(searched(more))
    # a query has at most k rows from each cell searched
    ranked = best(both.dropDuplicates(["query_id", "vec_id", "d"])).select("query_id", F.posexplode("best").alias("at", "b"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        F.sqrt("b.d").alias("score"),
    )


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark, sf):
    return nearest(table(spark, sf, "embeddings"))
