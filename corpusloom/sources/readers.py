"""Readers: pages, feeds, JSON indexes, JSON lines, item files, PDF bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import rules
from corpusloom.functions.markdown import strip_frontmatter
from corpusloom.functions.text import (
    blank_to_null,
    canonical_path,
    is_pdf_bytes,
    rfc822_date,
    strip,
)
from corpusloom.sources.files import read_heads, read_item_folders


def scan_pages(spark: SparkSession, path: str, category: str) -> DataFrame:
    """(page_id, url, category, html) of landed pages."""
    return spark.read.parquet(path).select(
        "page_id", "url", F.lit(category).alias("category"), "html"
    )


_CHANNEL = "struct<link: string, item: array<struct<title: string, link: string, pubDate: string, author: string>>>"


def feed_items(feeds: DataFrame, key: str = "feed_id", xml: str = "xml") -> DataFrame:
    """(key, ord, title, url_path, date, author) of every linked feed item."""
    parsed = feeds.select(key, F.from_xml(xml, F.lit(f"channel {_CHANNEL}")).alias("rss"))
    return _linked_items(parsed.select(key, F.col("rss.channel").alias("channel")), key)


def scan_feeds(spark: SparkSession, path: str) -> DataFrame:
    """(file, feed, ord, title, url_path, date, author) of the linked items of landed feed files.

    A file holds one feed or many; `feed` is the link of its channel. Files are cut
    behind the closing tags, so a large one is many tasks, and a malformed feed
    gives no rows while the others of its file do.
    """
    end = "</rss>"
    cut = spark.read.option("lineSep", end).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    # a feed that is left open ends where the next one starts
    one = F.regexp_extract("value", r"(?s)^.*(<rss\b.*)$", 1)
    rss = F.from_xml(F.concat(one, F.lit(end)), F.lit(f"channel {_CHANNEL}"))
    rows = cut.filter(one != "").select("file", rss.alias("rss"))
    channels = rows.select("file", strip(F.col("rss.channel.link")).alias("feed"), F.col("rss.channel").alias("channel"))
    return _linked_items(channels, "file", "feed")


def _linked_items(channels: DataFrame, *key: str) -> DataFrame:
    def clean(item: Column, name: str) -> Column:
        return strip(F.coalesce(item[name], F.lit("")))

    linked = F.filter(F.col("channel.item"), lambda i: clean(i, "link") != "")
    rows = channels.select(*key, F.posexplode(linked).alias("ord", "i"))
    i = F.col("i")
    return rows.select(
        *key,
        F.col("ord").cast("bigint").alias("ord"),
        clean(i, "title").alias("title"),
        canonical_path(clean(i, "link")).alias("url_path"),
        rfc822_date(clean(i, "pubDate")).alias("date"),
        clean(i, "author").alias("author"),
    )


def scan_json_index(
    spark: SparkSession, path: str, schema: T.StructType, array: bool = False
) -> DataFrame:
    """JSON records, one per line, or with `array` one JSON array per file.

    A missing file or corrupt records give no rows. Array files cannot be split,
    so the sinks here write lines.
    """
    bad = "_bad"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    try:
        text = spark.read.text(path, wholetext=array)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if array:
        rows = text.select(F.explode(F.from_json("value", T.ArrayType(wide), options)).alias("e"))
    else:
        rows = text.filter("trim(value) <> ''").select(F.from_json("value", wide, options).alias("e"))
    return rows.select("e.*").filter(F.col(bad).isNull()).drop(bad)


def parse_media_lines(df: DataFrame, line: str, tab: str, base: str) -> DataFrame:
    """One JSON object per line: blank and malformed lines and entries without an id go.

    The id falls back to the url, the title to ie_key then the id, and a url
    that is not http is rebuilt from the id.
    """
    schema = ("id string, url string, title string, ie_key string, upload_date string, "
              "duration bigint, view_count bigint")
    keep = [c for c in df.columns if c != line]
    parsed = df.select(*keep, F.from_json(strip(F.col(line)), schema).alias("e"))
    e = F.col("e")
    ident = F.coalesce(blank_to_null(e["id"]), blank_to_null(e["url"]))
    rows = parsed.withColumn("id", ident).filter("id is not null")
    rebuilt = F.concat(F.lit(base), "id")
    return rows.select(
        *keep,
        "id",
        F.coalesce(blank_to_null(e["title"]), e["ie_key"], F.col("id")).alias("title"),
        F.when(e["url"].startswith("http"), e["url"]).otherwise(rebuilt).alias("url"),
        F.coalesce(e["upload_date"], F.lit("")).alias("upload_date"),
        e["duration"].alias("duration"),
        e["view_count"].alias("view_count"),
        F.lit(tab).alias("tab"),
    )


def scan_jsonl_lenient(spark: SparkSession, path: str, tab: str, base: str) -> DataFrame:
    return parse_media_lines(spark.read.text(path), "value", tab, base)


def cached_listing(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False
) -> DataFrame:
    """A listing read from its Parquet copy, built and stored when absent or on request."""
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scan_item_files(spark: SparkSession, root: str) -> DataFrame:
    """(content_type, slug, meta, md, body) of `{type}/{slug}/{slug}.md` with its meta.json."""
    rows = read_item_folders(spark, root)
    return rows.withColumn("body", strip_frontmatter(F.col("md")))


def scan_pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, is_pdf) of the files of a folder, judged by their first bytes; an empty one is no PDF."""
    return read_heads(spark, path).select("path", "length", is_pdf_bytes(F.col("head")).alias("is_pdf"))


def media_defaults(json: Column) -> dict[str, Column]:
    """Fields of a stored media record with the defaults of absent keys."""
    def get(name: str) -> Column:
        return F.get_json_object(json, f"$.{name}")

    return {
        "id": get("id"),
        "title": get("title"),
        "url": get("url"),
        "upload_date": F.coalesce(get("upload_date"), F.lit("")),
        "duration": get("duration").cast("bigint"),
        "view_count": get("view_count").cast("bigint"),
        "tab": F.coalesce(get("tab"), F.lit("videos")),
    }
