"""The flagship query and the collected query book."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import compare as V
from corpusloom.functions import html as H
from corpusloom.functions import markdown as M
from corpusloom.functions import text as X
from corpusloom.plans import item_queries, report_queries, text_queries, web_queries  # noqa: F401
from corpusloom.plans.book import ORACLES, QUERIES, d_element, d_sub, d_text, query, table

__all__ = ["ORACLES", "QUERIES", "page_catalogue"]

_MAIN = d_text(d_element("html", "article"), "chr(10)")
_TITLE = d_text(d_element("html", "h1"))
_SLUG = "left(" + d_sub(
    "replace(trim(" + d_sub(f"lower({_TITLE})", r"[^a-z0-9\- ]") + "), ' ', '-')", "-{2,}", "-"
) + ", 80)"


@query(
    "page_catalogue",
    f"SELECT page_id, title, slug, path, words, unique_words, CASE WHEN all_words = 0 THEN 0.0::double "
    f"ELSE round(words / all_words, 4) END AS kept, summary || CASE WHEN words_ws > 30 THEN '…' ELSE '' END AS summary FROM (SELECT page_id, {_TITLE} AS title, {_SLUG} AS slug, "
    r"regexp_replace(url, '^https?://[^/]+', '') AS path, "
    f"len(regexp_extract_all(strip_accents({_MAIN}), '[A-Za-z0-9]+')) AS words, "
    f"len(list_distinct(list_transform(regexp_extract_all(strip_accents({_MAIN}), '[A-Za-z0-9]+'), "
    f"lambda w: lower(w)))) AS unique_words, "
    f"len(regexp_extract_all(strip_accents({d_text('html', 'chr(10)')}), '[A-Za-z0-9]+')) AS all_words, "
    f"array_to_string(regexp_split_to_array(replace({_MAIN}, '*', ''), '\\s+')[1:30], ' ') AS summary, "
    f"len(regexp_split_to_array(replace({_MAIN}, '*', ''), '\\s+')) AS words_ws FROM pages)",
)
def page_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """What is in the crawl, and how much of each page's text is main content.

    All of it happens within the row.
    """
    html = F.col("html")
    text = table(spark, sf, "pages").select(
        "page_id",
        "url",
        H.page_title(html).alias("title"),
        H.main_text(html, 0).alias("main"),
        H.html_text(html, "\n").alias("whole"),
    )
    words = V.with_tokens(text, {"tokens": "main", "all_tokens": "whole"}).withColumns(
        {"words": F.size("tokens"), "all_words": F.size("all_tokens")}
    )
    share = F.round(F.col("words") / F.col("all_words"), 4)
    return words.select(
        "page_id",
        "title",
        X.title_slug(F.col("title")).alias("slug"),
        X.canonical_path(F.col("url")).alias("path"),
        F.col("words").cast("bigint").alias("words"),
        F.size(V.unique_words(F.col("tokens"))).cast("bigint").alias("unique_words"),
        F.when(F.col("all_words") == 0, F.lit(0.0)).otherwise(share).alias("kept"),
        M.summary(F.col("main"), 30).alias("summary"),
    )
