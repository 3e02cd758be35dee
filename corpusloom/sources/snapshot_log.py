"""Page snapshots as a log: writes append, reads merge, compaction rewrites what is superseded.

Rows lie in folders by batch, category and day of their stamp; a manifest names
the live ones, so a reader sees whole writes only. Stamps are compared as text,
as `upsert_snapshots` does. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import rules
from corpusloom.operators.snapshots import fresh_snapshots, snapshot_stats, upsert_snapshots, with_freshness
from corpusloom.sources import store

TABLE = "snapshots"
FOLDER = ["batch", "kind", "day"]
NO_DAY = "none"  # of stamps that don't start with a date
NO_KIND = "none"
PREFIX = "c-"  # of a category's folders, so that an empty category has one


def _kinds(categories: tuple[str, ...]) -> set[str]:
    return {f"{PREFIX}{c}" for c in categories}


def _part(key: str, name: str) -> str:
    """The value of a partition column in a folder's name."""
    return unquote(next(p for p in key.split("/") if p.startswith(f"{name}="))[len(name) + 1 :])


@dataclass(frozen=True)
class SnapshotLog:
    """The log at `path`; `schema` has url, category, cached_at, content and the column that orders equal stamps."""

    spark: SparkSession
    path: str
    schema: T.StructType
    tiebreak: str

    def append(self, new: DataFrame) -> None:
        """Add snapshots. Nothing stored is read or written again."""
        held = store.current(self.spark, self.path)
        self._commit(held, {**held.tables.get(TABLE, {}), **self._write(new)})

    def read(self, categories: tuple[str, ...] | None = None) -> DataFrame:
        """The newest snapshot per (category, url), with its `url_key`; of some categories only where named."""
        held = store.current(self.spark, self.path)
        keys = [k for k in held.tables.get(TABLE, {}) if categories is None or _part(k, "kind") in _kinds(categories)]
        return self._merged(held, keys)

    def fresh(
        self, as_of: str, ttls: dict[str, int] = rules.CATEGORY_TTL, default: int = rules.DEFAULT_TTL,
        refresh: tuple[str, ...] = (), force_refresh: bool = False,
    ) -> DataFrame:
        """The newest snapshots that are still fresh.

        Days older than a category's time to live are not read: whatever is newest
        there is stale, and so is all that it supersedes. A day of margin covers
        stamps that carry another time zone.
        """
        held = store.current(self.spark, self.path)
        now = dt.datetime.fromisoformat(as_of)

        def may_hit(key: str) -> bool:
            kind, day = _part(key, "kind"), _part(key, "day")
            if force_refresh or kind in _kinds(refresh):
                return False
            since = now - dt.timedelta(seconds=ttls.get(kind.removeprefix(PREFIX), default), days=1)
            return day == NO_DAY or day >= since.date().isoformat()

        keys = [k for k in held.tables.get(TABLE, {}) if may_hit(k)]
        return fresh_snapshots(self._merged(held, keys), as_of, ttls=ttls, refresh=refresh, force_refresh=force_refresh)

    def stats(self, as_of: str, **options) -> DataFrame:
        """Entries, hits and misses by category of the newest snapshots."""
        return snapshot_stats(with_freshness(self.read(), as_of, **options))

    def invalidate(self, categories: tuple[str, ...] | None = None) -> int:
        """Drop categories, or all; how many entries went. Their folders leave the manifest, no row is rewritten."""
        held = store.current(self.spark, self.path)
        live = held.tables.get(TABLE, {})
        gone = [k for k in live if categories is None or _part(k, "kind") in _kinds(categories)]
        removed = self._merged(held, gone).count()
        if gone:
            self._commit(held, {k: f for k, f in live.items() if k not in gone})
        return removed

    def compact(self, most_batches: int = 8) -> list[str]:
        """Rewrite the folders that hold superseded rows, and days cut into more than `most_batches` folders.

        Returns the folders replaced. Other folders stay as they are, and what is
        read is the same before and after. `store.vacuum` deletes the files.
        """
        held = store.current(self.spark, self.path)
        live = held.tables.get(TABLE, {})
        if not live:
            return []
        rows = self._rows(held, list(live))
        order = F.struct("cached_at", self.tiebreak)
        per_folder = rows.groupBy("category", "url", *FOLDER).agg(F.count("*").alias("n"), F.max(order).alias("last"))
        newest = F.max("last").over(Window.partitionBy("category", "url"))
        stale = per_folder.withColumn("newest", newest).filter((F.col("n") > 1) | (F.col("last") < F.col("newest")))
        # at most as many as there are folders
        found = {tuple(r) for r in stale.select(*FOLDER).distinct().collect()}
        old = {k for k in live if tuple(_part(k, c) for c in FOLDER) in found}
        days: dict[tuple[str, str], list[str]] = {}
        for k in live:
            days.setdefault((_part(k, "kind"), _part(k, "day")), []).append(k)
        old |= {k for keys in days.values() if len(keys) > most_batches for k in keys}
        if not old:
            return []
        winners = rows.groupBy("category", "url").agg(F.max(order).alias("newest"))
        # columns of other names, since both sides come from the same scan
        winners = winners.select(F.col("category").alias("_c"), F.col("url").alias("_u"), F.col("newest").alias("_o"))
        best = upsert_snapshots(self._rows(held, sorted(old)).drop(*FOLDER), None, self.tiebreak)
        kept = best.join(
            winners,
            F.col("category").eqNullSafe(F.col("_c")) & F.col("url").eqNullSafe(F.col("_u")) & order.eqNullSafe(F.col("_o")),
            "left_semi",
        )
        new = self._write(kept)
        self._commit(held, {k: f for k, f in live.items() if k not in old} | new)
        return sorted(old)

    def _rows(self, held: store.Version, keys: list[str]) -> DataFrame:
        parts = [T.StructField(c, T.StringType()) for c in FOLDER]
        return store.read_table(self.spark, self.path, held, TABLE, T.StructType([*self.schema.fields, *parts]), keys)

    def _merged(self, held: store.Version, keys: list[str]) -> DataFrame:
        return upsert_snapshots(self._rows(held, keys).drop(*FOLDER), None, self.tiebreak)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows as a batch of their own: its folders."""
        dated = F.col("cached_at").rlike(r"^\d{4}-\d{2}-\d{2}")
        placed = rows.select(*self.schema.names).withColumns({
            "kind": F.coalesce(F.concat(F.lit(PREFIX), "category"), F.lit(NO_KIND)),
            "day": F.when(dated, F.left("cached_at", F.lit(10))).otherwise(NO_DAY),
        })
        return store.append_batch(placed, self.path, TABLE, ["kind", "day"], ["url"])

    def _commit(self, held: store.Version, folders: dict[str, str]) -> None:
        store.commit(self.spark, self.path, store.Version(
            held.number + 1, held.buckets, {**held.tables, TABLE: folders}, held.batches))
