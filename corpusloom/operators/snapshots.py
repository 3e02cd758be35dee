"""Landed page snapshots: freshness, last-write-wins upsert, invalidation, counts.

Snapshot columns: url, category, cached_at (string or timestamp), content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.text import url_key
from corpusloom.operators.scale import first_by


def ttl_of(category: Column, ttls: dict[str, int] = rules.CATEGORY_TTL,
           default: int = rules.DEFAULT_TTL) -> Column:
    """Seconds a category stays fresh. A handful of constants, so no join."""
    pairs = [F.lit(x) for kv in ttls.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(default))


def age_seconds(cached_at: Column, as_of: str) -> Column:
    """Age at `as_of`; null when the stamp does not parse."""
    stamp = F.try_to_timestamp(cached_at.cast("string"))
    return F.unix_micros(F.to_timestamp(F.lit(as_of))) / 1e6 - F.unix_micros(stamp) / 1e6


def with_freshness(
    snapshots: DataFrame,
    as_of: str,
    ttls: dict[str, int] = rules.CATEGORY_TTL,
    refresh: tuple[str, ...] = (),
    force_refresh: bool = False,
) -> DataFrame:
    """Adds `hit`: fresh enough to reuse and not asked to be refetched."""
    fresh = age_seconds(F.col("cached_at"), as_of) < ttl_of(F.col("category"), ttls)
    blocked = F.lit(force_refresh) | F.col("category").isin(*refresh)
    return snapshots.withColumn("hit", F.coalesce(fresh & ~blocked, F.lit(False)))


def fresh_snapshots(snapshots: DataFrame, as_of: str, **options) -> DataFrame:
    return with_freshness(snapshots, as_of, **options).filter("hit").drop("hit")


def upsert_snapshots(stored: DataFrame, new: DataFrame | None, tiebreak: str) -> DataFrame:
    """Newest write per (category, url); `tiebreak` orders equal stamps. The short key is a label only."""
    rows = stored if new is None else stored.unionByName(new)
    keyed = rows.withColumn("url_key", url_key(F.col("url")))
    return first_by(
        keyed, ["category", "url"], F.struct("cached_at", tiebreak), last=True
    )


def invalidate_snapshots(
    snapshots: DataFrame, categories: tuple[str, ...] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(entries kept, one-row count of entries removed); None removes everything."""
    gone = F.lit(True) if categories is None else F.col("category").isin(*categories)
    gone = F.coalesce(gone, F.lit(False))
    removed = snapshots.agg(F.count_if(gone).alias("removed"))
    return snapshots.filter(~gone), removed


def snapshot_stats(lookups: DataFrame, known=tuple(rules.CATEGORY_TTL)) -> DataFrame:
    """Entries, hits, misses and hit rate per category, `other` and `TOTAL`."""
    bucket = F.when(F.col("category").isin(*known), F.col("category")).otherwise("other")
    hits = F.count_if("hit")
    n = F.count("*")
    return (
        lookups.withColumn("category", bucket)
        .rollup("category")
        .agg(
            n.alias("entries"),
            hits.alias("hits"),
            (n - hits).alias("misses"),
            F.floor(hits * 100 / F.when(n > 0, n)).cast("bigint").alias("hit_rate"),
            F.grouping("category").alias("_total"),
        )
        .withColumn("category", F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("category")))
        .drop("_total")
    )
