"""Incremental runs of the batch operators with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.scale import first_by
from corpusloom.sources import store
from corpusloom.sources.writers import write_clean_items


def incremental_clean(
    raw: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    buckets: int,
    order: str | None = None,
    sections: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Clean newly landed raw rows and merge them into the items at `path`.

    A slug may land several times in one batch if `order` names the column that
    tells its latest version. `sections` gives the sections of a batch's
    policies, which replace those stored.

    A batch's items and sections become visible in one commit, which records the
    batch under the checkpoint's name: a batch replayed after a failure is merged
    once. Another checkpoint is another stream.
    """
    def merge(batch: DataFrame, number: int) -> None:
        if order is not None:
            batch = first_by(batch, ["slug"], F.col(order), last=True)
        told = None if sections is None else sections(batch)
        write_clean_items(clean(batch), path, buckets, told, (checkpoint, number))

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_seen_stream(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Rows whose key was not seen within `delay`; state is dropped behind the watermark.

    Late rows are dropped before keys are compared. All rows of a key meet in
    one stateful task, so a hot key is bounded by what one task reads in a batch.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


SEEN = "seen"


def first_seen_ever(
    events: DataFrame, key: str, order: list[str], path: str, checkpoint: str, buckets: int, most_batches: int = 16
) -> StreamingQuery:
    """Keep the first row of each key, however long ago it was seen, in the table at `path` (`read_first_seen`).

    The kept rows are the set of seen keys. They lie in buckets of the key's hash:
    a batch reads the keys of the buckets it touches and appends what is new, in one
    commit that records the batch, so a replay changes nothing. A bucket in more
    than `most_batches` folders is written again as one. Within a batch the first
    row by `order` counts, which must be unique within a key; a null is a key like
    others. A hot key sends one row a task.
    """
    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = store.current(spark, path)
        if held.batches.get(checkpoint, -1) >= number:
            return
        if held.buckets not in (None, buckets):
            raise ValueError(f"the table at {path} has {held.buckets} buckets, not {buckets}")
        live = held.tables.get(SEEN, {})
        first = first_by(batch, [key], F.struct(*order)).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        # at most as many as there are buckets
        touched = {str(r["bucket"]) for r in first.select("bucket").distinct().collect()}
        folders: dict[str, list[str]] = {}
        for k in live:
            folders.setdefault(k.rsplit("=", 1)[1], []).append(k)
        schema = T.StructType([*batch.schema.fields, T.StructField("bucket", T.LongType())])
        seen = store.read_table(spark, path, held, SEEN, schema, [k for b in sorted(touched) for k in folders.get(b, [])])
        known = seen.select("bucket", F.col(key).alias("_seen"))
        new = first.join(
            known, (first["bucket"] == known["bucket"]) & F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        old = [k for b in touched if len(folders.get(b, [])) >= most_batches for k in folders[b]]
        if old:
            new = new.unionByName(store.read_table(spark, path, held, SEEN, schema, old))
        kept = {k: f for k, f in live.items() if k not in old} | store.append_batch(new, path, SEEN, ["bucket"], [key])
        store.commit(spark, path, store.Version(
            held.number + 1, buckets, {**held.tables, SEEN: kept}, held.batches | {checkpoint: number}))

    return (
        events.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first_seen(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that `first_seen_ever` kept."""
    return store.read_table(spark, path, store.current(spark, path), SEEN, schema)
