"""Versions of a store of several tables: data files first, then one manifest that names them all.

A store has tables `items` and `sections`, each cut into partitions. Every write
puts the partitions it changes into new folders and commits by renaming one
manifest into place, so readers see either all of it or nothing, and a reader
that holds a version keeps reading that version's files. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifest"
CODEC = "zstd"  # of stored tables: most of what they hold is text


@dataclass(frozen=True)
class Version:
    """What a store holds: its number of buckets, live folders by table and partition, and the last batch of each stream."""

    number: int = 0
    buckets: int | None = None
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The latest version of the store at `path`, or the one of a number; empty where nothing was committed."""
    fs, folder = file_system(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return Version()
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))
    if not numbers:
        return Version()
    wanted = numbers[-1] if number is None else number
    text = spark.read.text(f"{path}/{MANIFESTS}/{wanted:012d}.json").first()[0]
    return Version(**json.loads(text))


def commit(spark: SparkSession, path: str, version: Version) -> None:
    """Put a version's manifest in place in one step; refused if that version exists."""
    name = f"{path}/{MANIFESTS}/{version.number:012d}.json"
    fs, final = file_system(spark, name)
    if fs.exists(final):
        raise RuntimeError(f"version {version.number} of {path} was committed by another writer")
    _, draft = file_system(spark, f"{path}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(version.__dict__).encode()))
    out.close()
    if not fs.rename(draft, final):
        raise RuntimeError(f"version {version.number} of {path} was committed by another writer")


def without_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A frame of a schema without rows, known to be empty when a query is planned: a join to it moves nothing."""
    return spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(
    spark: SparkSession, path: str, version: Version, table: str, schema: T.StructType, partitions: list[str] | None = None
) -> DataFrame:
    """A table at a version, with its partition columns; only some `partitions` where named."""
    live = version.tables.get(table, {})
    folders = [live[k] for k in (live if partitions is None else partitions) if k in live]
    if not folders:
        return without_rows(spark, schema)
    root = f"{path}/{table}"
    return (
        spark.read.schema(schema).option("basePath", root)
        .parquet(*[f"{root}/{k}" for k in folders]).select(*schema.names)
    )


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """The storage bucket of a slug, as `k-of-n`: so a table tells how many buckets it has."""
    spot = F.pmod(F.xxhash64("slug"), F.lit(buckets)).cast("string")
    return rows.withColumn("bucket", F.concat(spot, F.lit(f"-of-{buckets}")))


def write_partitions(
    rows: DataFrame, path: str, table: str, by: list[str], keys: list[str], sort: list[str] | None = None
) -> dict[str, str | None]:
    """Write rows, by partition columns, into new folders: {partition: folder}, null for the `keys` without rows.

    `keys` are the partitions that the rows may be in, as `a=x/b=y`. Files are
    sorted by `sort`, the slug where none is given.
    """
    batch = uuid.uuid4().hex
    (
        rows.withColumn("batch", F.lit(batch)).hint("rebalance", *[F.col(c) for c in by])
        .sortWithinPartitions(*by, *(sort or ["slug"]))
        .write.mode("append").option("compression", CODEC).partitionBy(*by, "batch").parquet(f"{path}/{table}")
    )
    out: dict[str, str | None] = {}
    for key in keys:
        folder = f"{key}/batch={batch}"
        fs, at = file_system(rows.sparkSession, f"{path}/{table}/{folder}")
        out[key] = folder if fs.exists(at) else None
    return out


def append_batch(rows: DataFrame, path: str, table: str, by: list[str], sort: list[str]) -> dict[str, str]:
    """Write rows as a batch of their own, cut by partition columns: its folders, `batch=…/a=x/b=y`.

    The batch comes first in a folder's name, so only the new folders are listed.
    """
    batch, root = uuid.uuid4().hex, f"{path}/{table}"
    (
        rows.withColumn("batch", F.lit(batch)).hint("rebalance", *[F.col(c) for c in by])
        .sortWithinPartitions(*by, *sort)
        .write.mode("append").option("compression", CODEC).partitionBy("batch", *by).parquet(root)
    )
    fs, found = file_system(rows.sparkSession, "/".join([root, f"batch={batch}", *[f"{c}=*" for c in by]]))
    names = ["/".join(s.getPath().toString().split("/")[-len(by) - 1 :]) for s in fs.globStatus(found) or []]
    return {n: n for n in names}


def changed(tables: dict[str, dict[str, str]], table: str, new: dict[str, str | None]) -> dict[str, dict[str, str]]:
    """The tables with some partitions of one replaced, or gone where they have no rows."""
    live = {k: f for k, f in tables.get(table, {}).items() if k not in new} | {k: f for k, f in new.items() if f is not None}
    return {**tables, table: live}


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the folders and manifests that none of the last `keep` versions names; how many folders went.

    Folders of a write that was never committed go too, so no writer may be at work.
    """
    last = current(spark, path).number
    versions = [current(spark, path, n) for n in range(max(1, last - keep + 1), last + 1)]
    live = {f"{t}/{f}" for v in versions for t, folders in v.tables.items() for f in folders.values()}
    fs, root = file_system(spark, path)
    gone = 0
    for t in {t for v in versions for t in v.tables}:
        depth = next((f.count("/") for v in versions for f in v.tables.get(t, {}).values()), None)
        if depth is None:
            continue
        found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{t}/" + "/".join(["*=*"] * (depth + 1))))
        for status in found or []:
            parts = status.getPath().toString().split("/")
            if f"{t}/" + "/".join(parts[-depth - 1 :]) not in live:
                gone += bool(fs.delete(status.getPath(), True))
    for status in fs.listStatus(file_system(spark, f"{path}/{MANIFESTS}")[1]):
        name = status.getPath().getName()
        if name.endswith(".json") and int(name.removesuffix(".json")) <= last - keep:
            fs.delete(status.getPath(), False)
    return gone
