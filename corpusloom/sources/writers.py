"""Sinks: clean items, index, raw records, validation, site tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import rules, schemas
from corpusloom.functions.text import title_slug
from corpusloom.operators.normalise import (
    COLLECTIONS,
    clean_index,
    merge_meta,
    rendered_md,
    section_table,
    site_table,
)
from corpusloom.operators.scale import first_by
from corpusloom.operators.validate import validation_summary
from corpusloom.sources import store, trigrams
from corpusloom.sources.store import with_bucket

KEYS = ["content_type", "slug"]
_BUCKET = T.StructField("bucket", T.StringType())
STORED_ITEM = T.StructType([*schemas.CLEAN_ITEM.fields, T.StructField("rendered_md", T.StringType()), _BUCKET])
STORED_SECTION = T.StructType([*schemas.SECTION.fields, _BUCKET])


def with_rendered(items: DataFrame) -> DataFrame:
    out = F.lit(None).cast("string")
    for t in schemas.TYPE_FIELDS:
        out = F.when(F.col("content_type") == t, rendered_md(t)).otherwise(out)
    return items.withColumn("rendered_md", out)


@dataclass(frozen=True)
class Store:
    """One version of the stored items and of the sections of their PDF files; goes where both are needed.

    `index` tells which of them may mention a text; null for a store without one.
    """

    items: DataFrame
    sections: DataFrame
    version: int
    index: trigrams.TextIndex | None = None


def read_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """The store at `path` as of its latest version or the one of a number; without one it has no rows."""
    held = store.current(spark, path, version)
    items = store.read_table(spark, path, held, "items", STORED_ITEM).drop("bucket")
    sections = store.read_table(spark, path, held, "sections", STORED_SECTION).drop("bucket")
    index = trigrams.TextIndex(spark, path, held, STORED_ITEM, STORED_SECTION) if _has_index(held.tables) else None
    return Store(items, sections, held.number, index)


def _has_index(tables: dict[str, dict[str, str]]) -> bool:
    return trigrams.ITEMS.postings in tables


def index_store(spark: SparkSession, path: str) -> None:
    """Build the text index of the store at `path`, as one commit; writes keep it up from then on."""
    held = store.current(spark, path)
    tables = held.tables
    for kind, schema in ((trigrams.ITEMS, STORED_ITEM), (trigrams.SECTIONS, STORED_SECTION)):
        tables = trigrams.indexed(spark, path, tables, kind, schema, list(tables.get(kind.table, {})))
    store.commit(spark, path, store.Version(held.number + 1, held.buckets, tables, held.batches))


def read_clean_items(spark: SparkSession, path: str) -> DataFrame:
    return read_store(spark, path).items


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    return read_store(spark, path).sections


def write_clean_items(
    items: DataFrame, path: str, buckets: int, sections: DataFrame | None = None, batch: tuple[str, int] | None = None
) -> None:
    """Merge-upsert into the store at `path`, and of `sections` into its sections, as one commit.

    The sections of every policy among the items, and of the policies in
    `sections`, are replaced as a set by those given, so an empty frame takes
    them away; without `sections` the stored ones stay as they are.

    Items are partitioned by content type and slug bucket, sections by bucket,
    and only partitions that hold something new are read and written again, into
    new folders. `buckets` is fixed for the life of a store; choose it so that
    one bucket is a few gigabytes. `batch` names a stream and its batch: one that
    the store has seen already changes nothing.
    """
    spark = items.sparkSession
    held = store.current(spark, path)
    if held.buckets not in (None, buckets):
        raise ValueError(f"the store at {path} has {held.buckets} buckets, not {buckets}")
    if batch is not None and held.batches.get(batch[0], -1) >= batch[1]:
        return
    new = with_bucket(items, buckets)
    keys = _touched(new)
    old = store.read_table(spark, path, held, "items", STORED_ITEM, keys).drop("rendered_md")
    merged = with_rendered(merge_meta(old, new, KEYS) if keys else new)
    tables = store.changed(
        held.tables, "items", store.write_partitions(merged, path, "items", ["content_type", "bucket"], keys))
    if _has_index(tables):
        tables = trigrams.indexed(spark, path, tables, trigrams.ITEMS, STORED_ITEM, keys)
    if sections is not None:
        slugs = new.filter("content_type = 'policy'").select("slug")
        tables = _with_sections(tables, sections, slugs, path, buckets, held)
    batches = held.batches | ({batch[0]: batch[1]} if batch is not None else {})
    store.commit(spark, path, store.Version(held.number + 1, buckets, tables, batches))


def write_sections(sections: DataFrame, slugs: DataFrame, path: str, buckets: int) -> None:
    """Replace the stored sections of `slugs` (slug), and of the slugs in `sections`, by `sections`."""
    spark = sections.sparkSession
    held = store.current(spark, path)
    if held.buckets not in (None, buckets):
        raise ValueError(f"the store at {path} has {held.buckets} buckets, not {buckets}")
    tables = _with_sections(held.tables, sections, slugs, path, buckets, held)
    store.commit(spark, path, store.Version(held.number + 1, buckets, tables, held.batches))


def _with_sections(
    tables: dict[str, dict[str, str]], sections: DataFrame, slugs: DataFrame, path: str, buckets: int, held: store.Version
) -> dict[str, dict[str, str]]:
    """The tables with sections replaced, and their postings where the store has an index."""
    new = _new_sections(sections, slugs, path, buckets, held)
    tables = store.changed(tables, "sections", new)
    if not _has_index(tables):
        return tables
    return trigrams.indexed(sections.sparkSession, path, tables, trigrams.SECTIONS, STORED_SECTION, list(new))


def _new_sections(
    sections: DataFrame, slugs: DataFrame, path: str, buckets: int, held: store.Version
) -> dict[str, str | None]:
    """Folders of the partitions of sections that change."""
    spark = sections.sparkSession
    new = with_bucket(schemas.conform(sections, schemas.SECTION), buckets).filter("detail is not null")
    replaced = with_bucket(slugs.select("slug").union(sections.select("slug")).distinct(), buckets)
    # at most as many as there are buckets
    keys = [f"bucket={r['bucket']}" for r in replaced.select("bucket").distinct().collect()]
    old = store.read_table(spark, path, held, "sections", STORED_SECTION, keys)
    # the texts move by slug only where some of them stay
    if not _strangers(old, replaced).isEmpty():
        new = new.unionByName(old.join(replaced.select("slug"), "slug", "left_anti"))
    return store.write_partitions(new, path, "sections", ["bucket"], keys)


def _strangers(sections: DataFrame, slugs: DataFrame) -> DataFrame:
    """The slugs of sections that are not among `slugs`, a null one always."""
    return sections.select("slug").distinct().join(slugs.select("slug"), "slug", "left_anti")


def _touched(items: DataFrame) -> list[str]:
    """The partitions that hold the items: at most content types times buckets of them."""
    found = items.select("content_type", "bucket").distinct().collect()
    if any(r["content_type"] not in rules.CONTENT_TYPES for r in found):
        raise ValueError(f"content_type must be one of {', '.join(rules.CONTENT_TYPES)}")
    return [f"content_type={r['content_type']}/bucket={r['bucket']}" for r in found]


def write_index(items: DataFrame, path: str) -> None:
    clean_index(items).write.mode("overwrite").json(path)


_STEMS = {
    "policy": lambda: F.col("slug"),
    "team-member": lambda: F.col("slug"),
    "party-information": lambda: F.lower(F.replace("section", F.lit(" "), F.lit("-"))),
    "blog-post": lambda: _dated_stem(),
    "event": lambda: _dated_stem(),
}


def _dated_stem():
    dated = F.when(F.col("date") != "", F.concat("date", F.lit("-"))).otherwise("")
    return F.concat(dated, title_slug(F.col("title")))


def raw_records(records: DataFrame, content_type: str, order: str) -> DataFrame:
    """Records with their file stem; the last of the same record wins.

    A stem made from a title is shortened, so the whole title tells records of
    one stem apart.
    """
    keyed = records.withColumn("file_key", _STEMS[content_type]())
    titled = content_type in ("blog-post", "event")
    named = keyed.withColumn("_title", F.col("title") if titled else F.lit(""))
    return first_by(named, ["file_key", "_title"], F.col(order), last=True).drop("_title")


def write_raw_records(records: DataFrame, content_type: str, order: str, path: str) -> None:
    raw_records(records, content_type, order).drop(order).write.mode("overwrite").parquet(path)


def write_validation(results: DataFrame, path: str) -> None:
    """Header and results as JSON under one folder."""
    validation_summary(results).write.mode("overwrite").json(f"{path}/summary")
    results.write.mode("overwrite").json(f"{path}/results")


def load_validation(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """{'summary': …, 'results': …}, or {} when nothing was written."""
    try:
        return {
            "summary": spark.read.schema(
                "threshold double, pdf_count bigint, passed_count bigint, failed_count bigint"
            ).json(f"{path}/summary"),
            "results": spark.read.schema(schemas.VALIDATION).json(f"{path}/results"),
        }
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def rebuild_site_tables(items: DataFrame | Store, path: str, sections: DataFrame | None = None) -> None:
    """Every collection wiped and rewritten from the clean items.

    What policies' PDF files say, the sections of a store or those given,
    follows their pages in `policy-sections`, in order of slug and file.
    """
    if isinstance(items, Store):
        items, sections = items.items, items.sections if sections is None else sections
    for collection in COLLECTIONS:
        site_table(items, collection).write.mode("overwrite").option("compression", store.CODEC).parquet(f"{path}/{collection}")
    if sections is None:
        sections = store.without_rows(items.sparkSession, schemas.SECTION)
    policies = items.filter("content_type = 'policy'").select("slug")
    if not _strangers(sections, policies).isEmpty():
        sections = sections.join(policies, "slug", "left_semi")
    told = section_table(sections).orderBy("slug", "file")
    told.write.mode("overwrite").option("compression", store.CODEC).parquet(f"{path}/policy-sections")
