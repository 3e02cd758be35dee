"""Extension points: new sources of clean items, and media platforms."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators.normalise import all_items

SourceFn = Callable[[SparkSession], DataFrame]
_SOURCES: dict[str, SourceFn] = {}


def register_source(name: str, fn: SourceFn) -> None:
    if name in _SOURCES:
        raise ValueError(f"source already registered: {name}")
    _SOURCES[name] = fn


def source_items(spark: SparkSession, name: str) -> DataFrame:
    """Items of a source; every provenance column must be there."""
    df = _SOURCES[name](spark)
    lacking = [c for c in (*schemas.PROVENANCE, "body") if c not in df.columns]
    if lacking:
        raise ValueError(f"source {name} lacks {', '.join(lacking)}")
    return schemas.conform(df)


def run_sources(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    return all_items(*[source_items(spark, n) for n in (names or list(_SOURCES))])


class MediaPlatform(Protocol):
    """What is left of a platform once fetching is someone else's job."""

    def enumerate(self, spark: SparkSession) -> DataFrame: ...

    def group(self, items: DataFrame) -> DataFrame: ...
