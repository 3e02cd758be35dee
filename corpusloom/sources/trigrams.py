"""Postings of the trigrams of stored texts: which items may mention a text.

Each partition of a table is cut into a fixed number of blocks by a hash of its
rows' keys, and a row (gram, doc) says that a text of that block holds three
consecutive characters. So postings grow with a table's different grams, not with
its rows. An index names candidates and the search itself looks at their texts.
Postings lie in the same partitions as the rows they point to and are committed
with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources import store

WIDTH = 3
BLOCKS = 256  # of a partition; another number needs another name of the tables of postings


@dataclass(frozen=True)
class Indexed:
    """A stored table whose texts have postings: its partition columns, texts and what numbers a row."""

    table: str
    postings: str
    by: list[str]
    texts: list[str]
    ident: list[str]

    @property
    def schema(self) -> T.StructType:
        strings = [T.StructField(c, T.StringType()) for c in self.by]
        return T.StructType([T.StructField("gram", T.StringType()), T.StructField("doc", T.IntegerType()), *strings])


ITEMS = Indexed("items", "item_gram_blocks", ["content_type", "bucket"], ["title", "name", "body"], ["slug"])
SECTIONS = Indexed("sections", "section_gram_blocks", ["bucket"], ["detail"], ["slug", "file"])


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case; none of a null or a shorter one.

    A lookahead lets the runs overlap in one pass over the text.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"(?s)(?=(.{{{WIDTH}}}))"), F.lit(1)))


def needle_grams(spark: SparkSession, needle: str) -> list[str]:
    """The grams of a text that is looked for, by the same expression; without a job."""
    return spark.sql("SELECT 1").select(grams(F.lit(needle))).first()[0]


def block(kind: Indexed) -> Column:
    """The number of the block of its partition that a row lies in."""
    return F.pmod(F.hash(*kind.ident), F.lit(BLOCKS))


def postings(rows: DataFrame, kind: Indexed) -> DataFrame:
    """(gram, doc, partition columns) of a table's rows, each gram once a block."""
    every = F.array_distinct(F.concat(*[grams(F.col(c)) for c in kind.texts]))
    return rows.select(F.explode(every).alias("gram"), block(kind).alias("doc"), *kind.by).distinct()


def mentions(kind: Indexed, needle: str) -> Column:
    """Whether one of a row's texts holds a text, whatever their case."""
    hit = F.lit(False)
    for c in kind.texts:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lower(F.lit(needle)))
    return hit


def indexed(
    spark: SparkSession, path: str, tables: dict[str, dict[str, str]], kind: Indexed, schema: T.StructType, keys: list[str]
) -> dict[str, dict[str, str]]:
    """The tables with the postings of some partitions built anew from the rows that now lie there."""
    rows = store.read_table(spark, path, store.Version(tables=tables), kind.table, schema, keys)
    new = store.write_partitions(postings(rows, kind), path, kind.postings, kind.by, keys, sort=["gram", "doc"])
    return store.changed(tables, kind.postings, new)


@dataclass(frozen=True)
class TextIndex:
    """The postings of one version of a store."""

    spark: SparkSession
    path: str
    held: store.Version
    items: T.StructType
    sections: T.StructType

    def hits(self, kind: Indexed, needle: str, under: str = "") -> DataFrame:
        """(partition columns, doc) of the blocks that hold all grams of the text; `under` starts the partitions looked at.

        Only rows of these grams are read, and the files are sorted by gram. The
        rows of a block are counted together, which only adds candidates.
        """
        wanted = needle_grams(self.spark, needle)
        keys = [k for k in self.held.tables.get(kind.postings, {}) if k.startswith(under)]
        found = store.read_table(self.spark, self.path, self.held, kind.postings, kind.schema, keys)
        counted = found.filter(F.col("gram").isin(wanted)).groupBy(*kind.by, "doc").agg(F.count("*").alias("n"))
        return counted.filter(F.col("n") >= len(wanted)).drop("n")

    def _rows(self, kind: Indexed, schema: T.StructType, hits: DataFrame) -> DataFrame:
        # at most as many as there are partitions, and as many blocks in each
        found = hits.select(*kind.by).distinct().collect()
        keys = ["/".join(f"{c}={r[c]}" for c in kind.by) for r in found]
        rows = store.read_table(self.spark, self.path, self.held, kind.table, schema, keys)
        blocks = F.broadcast(hits.distinct())
        return rows.withColumn("doc", block(kind)).join(blocks, [*kind.by, "doc"], "left_semi").drop("doc")

    def sections_with(self, needle: str) -> DataFrame:
        """Sections that may mention a text."""
        if len(needle) < WIDTH:
            return store.read_table(self.spark, self.path, self.held, "sections", self.sections).drop("bucket")
        return self._rows(SECTIONS, self.sections, self.hits(SECTIONS, needle)).drop("bucket")

    def items_with(self, needle: str, content_type: str, also: DataFrame | None = None) -> DataFrame:
        """Items of a type that mention a text, and those of the slugs in `also` and some beside them.

        A text of fewer than three characters has no grams: all items may mention it.
        """
        under = f"content_type={content_type}/"
        if len(needle) < WIDTH:
            keys = [k for k in self.held.tables.get("items", {}) if k.startswith(under)]
            return store.read_table(self.spark, self.path, self.held, "items", self.items, keys).drop("bucket")
        hits = self.hits(ITEMS, needle, under)
        if also is None:
            return self._rows(ITEMS, self.items, hits).filter(mentions(ITEMS, needle)).drop("bucket")
        named = store.with_bucket(also, self.held.buckets).select(
            F.lit(content_type).alias("content_type"), "bucket", block(ITEMS).alias("doc"))
        return self._rows(ITEMS, self.items, hits.unionByName(named)).drop("bucket")
