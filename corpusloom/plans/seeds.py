"""Reference-shaped inputs projected from the given tables.

Every seed is a literal projection over all rows of a table, written once as a
DataFrame and once as a SQL select, so both engines start from equal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.book import lit, spread, table

CLEANED_AT = "2026-01-03T00:00:00+00:00"
BASE = "https://www.example.org"


def _c(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _s(*parts: str) -> str:
    """SQL concatenation; parts starting with `=` are expressions, the rest literal text."""
    return " || ".join(f"({p[1:]})::varchar" if p.startswith("=") else lit(p) for p in parts)


def _col(name: str) -> Column:
    return F.col(name)


# --- policies: pages as raw policy markdown ---------------------------------

POLICY_SQL = (
    "SELECT page_id, 'page-' || page_id AS slug, url, title, "
    + _s("# ", "=title", "\n\n> **URL**: ", "=url", "\n> **Scraped**: 2026-01-01T00:00:00\n\n",
         "=body",
         "\n\n![x](y.png)\n\n\n\n[![a](b.png)](/c)\n\nCLOSE (X)\n\n### Check out more policies\nfoo")
    + " AS raw FROM (SELECT page_id, url, "
    r"regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '\s+', ' ', 'g') AS title, "
    r"regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), "
    r"'</p>', chr(10) || chr(10), 'g'), '<[^>]*>', '', 'g') AS body FROM pages)"
)


def policy_md(spark: SparkSession, sf: str) -> DataFrame:
    h1 = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    article = F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)
    body = F.regexp_replace(F.regexp_replace(article, "</p>", "\n\n"), "<[^>]*>", "")
    return (
        table(spark, sf, "pages")
        .select("page_id", "url", F.regexp_replace(h1, r"\s+", " ").alias("title"),
                body.alias("body"))
        .select(
            "page_id",
            _c("page-", _col("page_id")).alias("slug"),
            "url",
            "title",
            _c(
                "# ", _col("title"), "\n\n> **URL**: ", _col("url"),
                "\n> **Scraped**: 2026-01-01T00:00:00\n\n", _col("body"),
                "\n\n![x](y.png)\n\n\n\n[![a](b.png)](/c)\n\nCLOSE (X)\n\n"
                "### Check out more policies\nfoo",
            ).alias("raw"),
        )
    )


# --- blog posts: documents as raw blog markdown -----------------------------

BLOG_SQL = (
    "SELECT doc_id, 'post-' || doc_id AS slug, lang, source, text, "
    + _s("**Title**: Post ", "=doc_id", "\n**Date**: 2026-01-",
         "=lpad((doc_id % 28 + 1)::varchar, 2, '0')", "\n**Author**: ", "=source",
         "\n**URL**: https://www.example.org/blog/", "=doc_id",
         "\n**Scraped**: 2026-01-02T00:00:00\n**Note**: kept\n\n", "=text",
         "\n\n##### Media Contact\nx")
    + " AS raw FROM documents"
)


def blog_md(spark: SparkSession, sf: str) -> DataFrame:
    day = F.lpad((_col("doc_id") % 28 + 1).cast("string"), 2, "0")
    return table(spark, sf, "documents").select(
        "doc_id",
        _c("post-", _col("doc_id")).alias("slug"),
        "lang",
        "source",
        "text",
        _c(
            "**Title**: Post ", _col("doc_id"), "\n**Date**: 2026-01-", day, "\n**Author**: ",
            _col("source"), "\n**URL**: https://www.example.org/blog/", _col("doc_id"),
            "\n**Scraped**: 2026-01-02T00:00:00\n**Note**: kept\n\n", _col("text"),
            "\n\n##### Media Contact\nx",
        ).alias("raw"),
    )


# --- news: documents under a heading and quote ------------------------------

NEWS_SQL = (
    "SELECT doc_id, 'news-' || doc_id AS slug, "
    + _s("# News ", "=doc_id", "\n\n> **URL**: https://www.example.org/news/", "=doc_id",
         "\n> **Scraped**: 2026-01-02T00:00:00\n\n", "=text", "\n\n## Get Involved\ny")
    + " AS raw FROM documents"
)


def news_md(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        _c("news-", _col("doc_id")).alias("slug"),
        _c(
            "# News ", _col("doc_id"), "\n\n> **URL**: https://www.example.org/news/",
            _col("doc_id"), "\n> **Scraped**: 2026-01-02T00:00:00\n\n", _col("text"),
            "\n\n## Get Involved\ny",
        ).alias("raw"),
    )


# --- events -----------------------------------------------------------------

EVENT_SQL = (
    "SELECT event_id, 'event-' || event_id AS slug, strftime(ts, '%Y-%m-%d') AS date, "
    "event_type, user_id, "
    + _s("**Title**: Event ", "=event_id", "\n**Date**: ", "=strftime(ts, '%Y-%m-%d')",
         "\n**Location**: City ", "=user_id % 50", "\n**When**: ", "=strftime(ts, '%H:%M')",
         "\n**Venue**: ", "=event_type", " hall\n**Address**: ", "=user_id",
         " Queen Street\n**Time**: 9am\n**URL**: https://www.example.org/events/", "=event_id",
         "\n\nprops ", "=props", "\n\n\n\nEnd")
    + " AS raw FROM events"
)


def event_md(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "events")).select(
        "event_id",
        _c("event-", _col("event_id")).alias("slug"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "event_type",
        "user_id",
        _c(
            "**Title**: Event ", _col("event_id"), "\n**Date**: ",
            F.date_format("ts", "yyyy-MM-dd"), "\n**Location**: City ", _col("user_id") % 50,
            "\n**When**: ", F.date_format("ts", "HH:mm"), "\n**Venue**: ", _col("event_type"),
            " hall\n**Address**: ", _col("user_id"),
            " Queen Street\n**Time**: 9am\n**URL**: https://www.example.org/events/",
            _col("event_id"), "\n\nprops ", _col("props"), "\n\n\n\nEnd",
        ).alias("raw"),
    )


# --- members: customers with their nation -----------------------------------

_ROLE_SQL = (
    "CASE WHEN c_custkey % 97 = 5 THEN 'Party Leader' WHEN c_custkey % 89 = 7 "
    "THEN 'Deputy Leader' ELSE 'Candidate' END"
)
_AREA_SQL = "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE replace(n_name, '_', ' ') END"
MEMBER_SQL = (
    f"SELECT c_custkey, lower(replace(c_name, '#', '-')) AS slug, "
    f"replace(c_name, '#', ' ') AS name, {_ROLE_SQL} AS role, {_AREA_SQL} AS electorate, "
    "'https://www.example.org/team/' || c_custkey AS url, c_mktsegment AS segment "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
)


def members(spark: SparkSession, sf: str) -> DataFrame:
    key = _col("c_custkey")
    role = (
        F.when(key % 97 == 5, "Party Leader")
        .when(key % 89 == 7, "Deputy Leader")
        .otherwise("Candidate")
    )
    area = F.when(key % 11 == 0, "").otherwise(F.replace("n_name", F.lit("_"), F.lit(" ")))
    nation = table(spark, sf, "nation")
    return spread(table(spark, sf, "customer")).join(nation, _col("c_nationkey") == _col("n_nationkey")).select(
        "c_custkey",
        F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("slug"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"),
        role.alias("role"),
        area.alias("electorate"),
        _c("https://www.example.org/team/", key).alias("url"),
        _col("c_mktsegment").alias("segment"),
    )


MEMBER_MD_SQL = (
    "SELECT slug, name, role, electorate, url, "
    + _s("# ", "=name", "\n\n**Role**: ", "=role", "\n**Electorate**: ", "=electorate",
         "\n\n> **URL**: ", "=url", "\n> **Scraped**: 2026-01-01T00:00:00\n\nSegment ", "=segment",
         "\n\n##### Media Contact\nz")
    + f" AS raw FROM ({MEMBER_SQL})"
)


def member_md(spark: SparkSession, sf: str) -> DataFrame:
    return members(spark, sf).select(
        "slug", "name", "role", "electorate", "url",
        _c(
            "# ", _col("name"), "\n\n**Role**: ", _col("role"), "\n**Electorate**: ",
            _col("electorate"), "\n\n> **URL**: ", _col("url"),
            "\n> **Scraped**: 2026-01-01T00:00:00\n\nSegment ", _col("segment"),
            "\n\n##### Media Contact\nz",
        ).alias("raw"),
    )


# --- PDFs: documents as raw extracted markdown, and as converted files ------

PDF_SQL = (
    "SELECT doc_id, text, source, lang, "
    + _s("Date **January 2026** Policy **", "=source", "** Document Type **", "=lang",
         " paper**\n**==> picture [1 x 1] <==**\n\n## **1. Aims**\n\n", "=text",
         "\n\n\n\n**Page 1**\nExample Org  Tax  Page 2\nPage 3\n\n## **1.1 Steps.Then**\n\n- a\n- b\n\n"
         "| A | B |\n|---|---|\n| 1 | 2 |\n")
    + " AS raw FROM documents"
)


def pdf_raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", "text", "source", "lang",
        _c(
            "Date **January 2026** Policy **", _col("source"), "** Document Type **",
            _col("lang"), " paper**\n**==> picture [1 x 1] <==**\n\n## **1. Aims**\n\n",
            _col("text"),
            "\n\n\n\n**Page 1**\nExample Org  Tax  Page 2\nPage 3\n\n## **1.1 Steps.Then**\n\n"
            "- a\n- b\n\n| A | B |\n|---|---|\n| 1 | 2 |\n",
        ).alias("raw"),
    )


# A policy owns up to eight documents; every fifth policy has no page of its own.
PDF_FILE_SQL = (
    "SELECT doc_id, 'pol-' || (doc_id // 8) AS policy_slug, 'pdf-part-' || (doc_id % 8) || '.md' "
    "AS file, text, "
    + _s("# ", "=source", " — ", "=lang", "\n| Field | Value |\n|-------|-------|\n| Policy | ",
         "=source", " |\n| Document Type | ", "=lang", " paper |\n| Source | `d", "=doc_id",
         ".pdf` |\n\n**Tax**\n\n## **Contents**\n|1|2|\n\n## **1. Aims**\n\n", "=text",
         "\n# Drop me\n")
    + " AS raw FROM documents"
)


def pdf_files(spark: SparkSession, sf: str) -> DataFrame:
    key = _col("doc_id")
    return table(spark, sf, "documents").select(
        "doc_id",
        _c("pol-", F.floor(key / 8).cast("bigint")).alias("policy_slug"),
        _c("pdf-part-", key % 8, ".md").alias("file"),
        "text",
        _c(
            "# ", _col("source"), " — ", _col("lang"),
            "\n| Field | Value |\n|-------|-------|\n| Policy | ", _col("source"),
            " |\n| Document Type | ", _col("lang"), " paper |\n| Source | `d", key,
            ".pdf` |\n\n**Tax**\n\n## **Contents**\n|1|2|\n\n## **1. Aims**\n\n", _col("text"),
            "\n# Drop me\n",
        ).alias("raw"),
    )


# The cleaned body of a PDF file above, written out.
PDF_BODY_SQL = _s(
    "<!-- The Contents (TOC) table has been removed during transformation; "
    "the rendered document provides its own navigation. -->\n\n\n## **1. Aims**\n\n",
    "=text", "\n\n",
)

# --- policies and their downloads -------------------------------------------

# Documents as policies; labelled documents have a stored pdf.
POLICY_PDF_SQL = (
    "SELECT doc_id, 'doc-' || doc_id AS slug, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE "
    "'Title ' || (doc_id % 100) END AS title, lang, source, CASE WHEN doc_id % 3 = 0 THEN "
    "['https://drive.google.com/file/d/F' || doc_id || '/view'] WHEN doc_id % 3 = 1 THEN "
    "['https://files.example.org/a/d' || doc_id || '.pdf', "
    "'https://drive.google.com/file/d/G' || (doc_id % 40) || '/view'] "
    "ELSE CAST([] AS varchar[]) END AS pdf_downloads FROM documents"
)


def policy_pdfs(spark: SparkSession, sf: str) -> DataFrame:
    key = _col("doc_id")
    urls = (
        F.when(key % 3 == 0, F.array(_c("https://drive.google.com/file/d/F", key, "/view")))
        .when(
            key % 3 == 1,
            F.array(
                _c("https://files.example.org/a/d", key, ".pdf"),
                _c("https://drive.google.com/file/d/G", key % 40, "/view"),
            ),
        )
        .otherwise(F.array().cast("array<string>"))
    )
    return table(spark, sf, "documents").select(
        "doc_id",
        _c("doc-", key).alias("slug"),
        F.when(key % 13 != 0, _c("Title ", key % 100)).alias("title"),
        "lang",
        "source",
        urls.alias("pdf_downloads"),
    )


REGISTRY_SQL = (
    "SELECT doc_id AS ord, 'F' || doc_id AS key, 'doc-' || doc_id AS policy_slug, "
    "'f' || (doc_id % 200) || '.pdf' AS filename, md5(text) AS md5, doc_id % 2 = 0 AS present "
    "FROM documents SEMI JOIN labels USING (doc_id)"
)


def registry(spark: SparkSession, sf: str) -> DataFrame:
    key = _col("doc_id")
    labelled = table(spark, sf, "labels").select("doc_id").distinct()
    return table(spark, sf, "documents").join(labelled, "doc_id", "left_semi").select(
        key.alias("ord"),
        _c("F", key).alias("key"),
        _c("doc-", key).alias("policy_slug"),
        _c("f", key % 200, ".pdf").alias("filename"),
        F.md5("text").alias("md5"),
        (key % 2 == 0).alias("present"),
    )


# --- snapshots --------------------------------------------------------------

SNAPSHOT_SQL = (
    "SELECT event_id, 'https://www.example.org/u/' || user_id AS url, CASE event_type "
    "WHEN 'view' THEN 'blog' WHEN 'click' THEN 'events' WHEN 'purchase' THEN 'policies' "
    "WHEN 'signup' THEN 'team' ELSE 'misc' END AS category, CASE WHEN event_id % 17 = 0 "
    "THEN 'garbled' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS cached_at, props AS content "
    "FROM events"
)
AS_OF = "2024-01-31 00:00:00"


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    kind = _col("event_type")
    category = (
        F.when(kind == "view", "blog")
        .when(kind == "click", "events")
        .when(kind == "purchase", "policies")
        .when(kind == "signup", "team")
        .otherwise("misc")
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        _c("https://www.example.org/u/", _col("user_id")).alias("url"),
        category.alias("category"),
        F.when(_col("event_id") % 17 == 0, "garbled").otherwise(stamp).alias("cached_at"),
        _col("props").alias("content"),
    )


# --- pages with more links than the crawl has -------------------------------

_EXTRA = (
    '<ul><li><h4>Annual Report ', "=page_id % 9",
    '</h4><a href="https://drive.google.com/file/d/ID', "=page_id",
    '/view">Get it</a></li><li><a href="/files/doc', "=page_id",
    '.PDF">Direct</a></li><li><a href="/candidate-jo-', "=page_id % 50",
    '"><h3>Jo ', "=page_id % 50", '</h3> Candidate</a></li><li><a href="/candidate-al-',
    "=page_id % 30", '">Al</a></li><li><a href="/policy/p', "=page_id % 20",
    '/">p</a></li><li><a href="/about/registration-rules">', "=page_id % 2",
    '</a></li></ul><a href="/x/Governance-docs/"></a><a href="https://ext.example.org/x?a=1&amp;b=',
    "=page_id", '">e</a>',
)
LINKED_SQL = (
    "SELECT page_id, url, replace(html, '</article>', "
    + _s(*_EXTRA) + " || '</article>') AS html FROM pages"
)


def linked_pages(spark: SparkSession, sf: str) -> DataFrame:
    parts = [F.expr(p[1:]) if p.startswith("=") else p for p in _EXTRA]
    extra = _c(*parts, "</article>")
    return table(spark, sf, "pages").select(
        "page_id", "url", F.replace("html", F.lit("</article>"), extra).alias("html")
    )


# --- profile pages ----------------------------------------------------------


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per member, with a login heading before the real one."""
    key = _col("c_custkey")
    text = (
        F.when(key % 3 == 0, "Party Leader &amp; Candidate for Example")
        .when(key % 3 == 1, "Candidate for Example and Deputy Leader")
        .otherwise("Ask us")
    )
    tag = F.when(key % 4 == 0, "div").otherwise("main")
    return members(spark, sf).select(
        "c_custkey", "slug", "name", "electorate",
        _c(
            "<html><head><title>", _col("name"), " | Site</title></head><body><h1>Sign in</h1><",
            tag, "><h4>", F.upper("electorate"), "</h4><h4>donate</h4><h1><span>", _col("name"),
            "</span>   <span>Jr.</span></h1><p>Bio <a href=\"/cdn-cgi/l/email-protection#1\">"
            "[mail]</a></p><h5><b>Media Contact</b></h5><p></p><p>Call</p><p>", text, "</p></",
            tag, "></body></html>",
        ).alias("html"),
    )


# --- event cards ------------------------------------------------------------


def card_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages with three cards: named, plain text parts, and one without a link."""
    key = _col("page_id")
    day = (key % 28 + 1).cast("string")
    return table(spark, sf, "pages").select(
        "page_id",
        F.replace("html", F.lit("</article>"), _c(
            '<div class="event-card big"><span>Jun ', day, ', 2026</span><a href="/events/', key,
            '"><span class="event__name">Meetup ', key, "</span></a><p>Town ", key % 7,
            ', Region</p></div><div class="event-card"><p>March ', day,
            ', 2026</p><p>Big rally ', key, '</p><p>City Hall</p><a href="events/r', key,
            '">RSVP</a></div><div class="event-card"><p>Nothing here</p></div></article>',
        )).alias("html"),
    )
