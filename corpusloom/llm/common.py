"""Shared by the operators of this subpackage: words, hashes, stored tables, the query book."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# A word is a run of characters other than these six; as a pattern for Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- words and hashes, in Python tasks ---------------------------------------


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words of a text. bytes.split and bytes.lower know ASCII only, as WORD does."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which close inputs end up far apart."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes; empty if there are fewer.

    Windows of a power-of-two length come from two halves each, so the cost
    grows with log k and every word's place in the window counts.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done = np.full(n, np.uint64(k))
    level, size, at = h, 1, 0
    while k:
        if k & 1:
            done = mix(done * np.uint64(0x9E3779B97F4A7C15) + level[at : at + n])
            at += size
        k >>= 1
        if k:
            level = mix(level[:-size] * np.uint64(0xD6E8FEB86659FD93) + level[size:])
            size *= 2
    return done


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def unsigned(h) -> np.ndarray:
    return np.asarray(h, np.int64).view(np.uint64)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Python tasks get at most so many rows at once: whole texts, and pairs of them, are large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, rows)


# Shuffle files go as soon as the query that wrote them has ended; what is stored is read from its table.
FREED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session while tables are stored; the caller's own are put back."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# --- columns -----------------------------------------------------------------


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves `part` modulo `parts`; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learnt: Column, rows: tuple[int, int], chars: int
) -> tuple[list[tuple], dict[int, int]]:
    """([(id, text, label)] by id, {label: ids that have it}) to fit a classifier on.

    Ids are taken where `learnt`, a condition on `_id`, holds and their labels
    agree on 0 or 1: about rows[0] of label 0 and rows[1] of label 1, chosen by a
    hash of the id, and of those the ones with a text of at most `chars`
    characters. An id gives one text, the least, however often it is repeated,
    so the driver gets no more rows than ids were chosen. Empty without both
    labels.
    """
    agreed = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_y"))
        .filter(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & learnt)
        .groupBy("_id").agg(F.min("_y").alias("y"), F.max("_y").alias("_max")).filter("y = _max").select("_id", "y")
    )
    have = {r["y"]: r["count"] for r in agreed.groupBy("y").count().collect()}
    if len(have) < 2:
        return [], have
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000.0
    share = F.when(F.col("y") == 1, rows[1] / have[1]).otherwise(rows[0] / have[0])
    found = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .filter(F.length("_text") <= chars)
        # as many ids as the sample has rows
        .join(F.broadcast(agreed.filter(draw < share)), "_id")
        .groupBy("_id").agg(F.min("_text").alias("_text"), F.first("y").alias("y")).collect()
    )
    return sorted((r["_id"], r["_text"], r["y"]) for r in found), have


def bit_words(places: DataFrame) -> DataFrame:
    """(w, b) of the bitmap with a bit set for each place (column p) of the frame: number w of it, 64 bits, is b; the others are 0."""
    return places.groupBy(F.expr("cast(p div 64 as int)").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")
    )


def bits_set(places: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits, with one set for each place (column p) of the frame, 64 to a number."""
    words = bit_words(places).toArrow()  # arrays: the driver makes no object for each row
    found = np.zeros(1 << (bits - 6), np.int64)
    found[words["w"].to_numpy()] = words["b"].to_numpy()
    return found


def with_may_be_in(rows: DataFrame, key: str, wanted: DataFrame, name: str, bits: int = 24) -> DataFrame:
    """rows and the column `name`: whether the column `key` may be among `wanted`, a frame of that one column.

    A bitmap of bounded size, whatever the number of keys: it spares rows that
    are surely not wanted a shuffle, and lets more others through the more keys
    there are, so a join must follow. Its numbers are looked up by a broadcast
    join, so that no Python worker holds it beside the one of a task's own step.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    # stored first: a broadcast must not wait for what makes the keys
    found = stored(bit_words(wanted.select(place.alias("p"))).toDF("_cl_word", "_cl_bits"))
    told = rows.withColumn("_cl_place", place).join(
        F.broadcast(found), F.expr("cast(_cl_place div 64 as int)") == F.col("_cl_word"), "left")
    bit = F.expr("shiftright(_cl_bits, cast(_cl_place % 64 as int))").bitwiseAND(F.lit(1)) == 1
    return told.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_cl_place", "_cl_word", "_cl_bits")


def sieve(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be wanted."""
    return with_may_be_in(rows, key, wanted, "_cl_wanted").filter("_cl_wanted").drop("_cl_wanted")


# --- stored tables -------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. Where none is set, as in tests, a local one is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-llm-")


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage and survives lost executors.

    With `by`, each value of that column has a folder of its own, so that a
    filter on it reads no other.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpusloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*[by] if by else []).parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._corpusloom_path = path
    return again


def dropped(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._corpusloom_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others may have names that clash with an operator's own."""
    return docs.select(*names)
