"""Queries over markdown bodies and scalars: cleaning, repair, slugs, dates, metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import compare as V
from corpusloom.functions import markdown as M
from corpusloom.functions import repair as Q
from corpusloom.functions import text as X
from corpusloom.operators import reports as G
from corpusloom.plans import seeds
from corpusloom.plans.book import (
    d_collapse,
    d_get,
    d_lines,
    d_rstrip,
    d_strip,
    d_sub,
    d_title,
    d_unlines,
    lit,
    query,
    table,
)
from corpusloom.plans.seeds import (
    BLOG_SQL,
    EVENT_SQL,
    MEMBER_SQL,
    PDF_BODY_SQL,
    PDF_FILE_SQL,
    PDF_SQL,
    POLICY_SQL,
)


def _from(seed: str, **cols: str) -> str:
    picks = ", ".join(f"{expr} AS {name}" for name, expr in cols.items())
    return f"SELECT {picks} FROM ({seed})"


# --- markdown cleaning ------------------------------------------------------

_LEAD = r"^(?:\s+\z|\s*\n)"


def _d_no_quote(x: str) -> str:
    kept = f"list_filter({d_lines(x)}, lambda l: NOT regexp_matches(l, '^>\\s*\\*\\*(URL|Scraped)\\*\\*:'))"
    return d_sub(d_unlines(kept), _LEAD, "", "")


def _d_no_images(x: str) -> str:
    pat = r"^(?:\[?!\[.*?\]\(.*?\)\]?\(.*?\)?|!\[.*?\]\(.*?\))\s*$"
    kept = f"list_filter({d_lines(x)}, lambda l: NOT regexp_matches({d_strip('l')}, '{pat}'))"
    return d_collapse(d_unlines(kept))


def _d_no_footer(x: str) -> str:
    return d_rstrip(d_sub(x, r"(?s)(?:###\s*Check out more policies|##\s*Get Involved).*", "", ""))


def _d_no_carousel(x: str) -> str:
    cut = d_sub(x, r"(?is)CLOSE\s*\(X\).*", "", "")
    return d_rstrip(d_sub(cut, r"Previous\s*\n\s*Next\s*\z", "", ""))


def _d_no_contact(x: str) -> str:
    return d_rstrip(d_sub(x, r"(?s)#####\s*Media Contact.*", "", ""))


def _d_no_h1(x: str, title: str) -> str:
    pat = f"'^(?:#\\s+' || regexp_escape(trim({title})) || '\\s*\\n)+'"
    return f"ltrim(regexp_replace({x}, {pat}, ''), chr(10))"


def d_clean(x: str, title: str, footer: bool = True, contact: bool = True) -> str:
    if footer:
        x = _d_no_footer(x)
    x = _d_no_carousel(_d_no_images(_d_no_quote(x)))
    if contact:
        x = _d_no_contact(x)
    return d_collapse(_d_no_h1(x, title))


KEYS = "Title|Date|Author|Location|URL|Scraped|When|Venue|Address|Role|Electorate"


def d_field(x: str, key: str) -> str:
    pat = f"^\\*\\*{key}\\*\\*:\\s*(.+)$"
    hits = f"list_filter({d_lines(x)}, lambda l: regexp_matches({d_strip('l')}, '{pat}'))"
    return d_strip(f"regexp_extract({d_strip(f'list_last({hits})')}, '{pat}', 1)")


def d_no_fields(x: str) -> str:
    pat = f"^\\*\\*({KEYS})\\*\\*:\\s*(.+)$"
    return d_unlines(f"list_filter({d_lines(x)}, lambda l: NOT (regexp_matches({d_strip('l')}, '{pat}') OR regexp_matches(l, '{pat}')))")


def d_quote_field(x: str, key: str) -> str:
    hits = f"regexp_extract_all({x}, '(?m)^>\\s*\\*\\*{key}\\*\\*:\\s*(.+)$', 1)"
    return d_strip(f"list_last({hits})")


def d_h1(x: str) -> str:
    return d_strip(d_get(x, r"(?m)^#[ \t]+(.+)$", 1))


@query(
    "c01_strip_contents_section",
    _from(
        PDF_FILE_SQL, doc_id="doc_id", removed="true",
        body="split_part(raw, '## **Contents**', 1) || chr(10) || '## **1. Aims**' "
        "|| split_part(raw, '## **1. Aims**', 2)",
    ),
)
def _(spark, sf):
    body, removed = M.strip_contents_section(F.col("raw"))
    return seeds.pdf_files(spark, sf).select(
        "doc_id", body.alias("body"), removed.alias("removed")
    )


@query(
    "c02_strip_metadata_blockquote",
    _from(POLICY_SQL, page_id="page_id", body=_d_no_quote("regexp_replace(raw, '^# [^\\n]*\\n', '')")),
)
def _(spark, sf):
    raw = F.regexp_replace("raw", r"^# [^\n]*\n", "")
    return seeds.policy_md(spark, sf).select(
        "page_id", M.strip_metadata_blockquote(raw).alias("body")
    )


@query("c03_strip_image_lines", _from(POLICY_SQL, page_id="page_id", body=_d_no_images("raw")))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select(
        "page_id", M.strip_image_lines(F.col("raw")).alias("body")
    )


@query("c04_strip_footer", _from(POLICY_SQL, page_id="page_id", body=_d_no_footer("raw")))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select(
        "page_id", M.strip_footer_sections(F.col("raw")).alias("body")
    )


@query("c05_strip_duplicate_h1", _from(
    POLICY_SQL, page_id="page_id",
    body="ltrim(substr(raw, instr(raw, chr(10))), chr(10))",
))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select(
        "page_id", M.strip_duplicate_h1(F.col("raw"), F.col("title")).alias("body")
    )


@query(
    "c06_extract_metadata_fields",
    _from(
        EVENT_SQL, event_id="event_id", title=d_field("raw", "Title"), date=d_field("raw", "Date"),
        location=d_field("raw", "Location"), venue=d_field("raw", "Venue"),
        address=d_field("raw", "Address"), url=d_field("raw", "URL"), n="7::bigint",
        body=d_no_fields("raw"),
    ),
)
def _(spark, sf):
    rows = seeds.event_md(spark, sf).withColumn("m", M.metadata_fields(F.col("raw")))
    return rows.select(
        "event_id",
        *[M.field(F.col("m"), k).alias(k.lower()) for k in
          ("Title", "Date", "Location", "Venue", "Address", "URL")],
        F.size("m").cast("bigint").alias("n"),
        M.without_metadata_fields(F.col("raw")).alias("body"),
    )


@query("c07_collapse_blank_runs", _from(EVENT_SQL, event_id="event_id", body=d_collapse("raw")))
def _(spark, sf):
    return seeds.event_md(spark, sf).select(
        "event_id", M.collapse_blank_runs(F.col("raw")).alias("body")
    )


@query("c08_remove_close_carousel", _from(
    POLICY_SQL, page_id="page_id", cut=_d_no_carousel("raw"),
    nav=_d_no_carousel("title || chr(10) || 'Previous' || chr(10) || '  Next ' || chr(10)"),
))
def _(spark, sf):
    nav = F.concat("title", F.lit("\nPrevious\n  Next \n"))
    return seeds.policy_md(spark, sf).select(
        "page_id",
        M.remove_close_carousel(F.col("raw")).alias("cut"),
        M.remove_close_carousel(nav).alias("nav"),
    )


@query("c09_remove_media_contact", _from(BLOG_SQL, doc_id="doc_id", body=_d_no_contact("raw")))
def _(spark, sf):
    return seeds.blog_md(spark, sf).select(
        "doc_id", M.remove_media_contact(F.col("raw")).alias("body")
    )


@query("c10_clean_body", _from(
    POLICY_SQL, page_id="page_id", body=d_clean("raw", "title"),
    plain=d_clean("raw", "title", False, False),
))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select(
        "page_id",
        M.clean_body(F.col("raw"), F.col("title")).alias("body"),
        M.clean_body(F.col("raw"), F.col("title"), False, False).alias("plain"),
    )


@query("c11_blockquote_meta", _from(
    POLICY_SQL, page_id="page_id", url=d_quote_field("raw", "URL"),
    scraped=d_quote_field("raw", "Scraped"),
))
def _(spark, sf):
    rows = seeds.policy_md(spark, sf).withColumn("m", M.blockquote_meta(F.col("raw")))
    return rows.select(
        "page_id", M.field(F.col("m"), "URL").alias("url"),
        M.field(F.col("m"), "Scraped").alias("scraped"),
    )


@query("c12_h1_title", _from(
    POLICY_SQL, page_id="page_id", title=d_h1("raw"), none=d_h1("'a' || chr(10) || title"),
))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select(
        "page_id",
        M.h1_title(F.col("raw")).alias("title"),
        M.h1_title(F.concat(F.lit("a\n"), "title")).alias("none"),
    )


@query("c13_pdf_table_meta", _from(
    PDF_FILE_SQL, doc_id="doc_id", policy=d_get("raw", r"\| Policy \| (.*) \|", 1),
    doc_type=d_get("raw", r"\| Document Type \| (.*) \|", 1), source="'d' || doc_id || '.pdf'",
    one="'2'", n="4::bigint",
))
def _(spark, sf):
    rows = seeds.pdf_files(spark, sf).withColumn("m", M.pdf_table_meta(F.col("raw")))
    m = F.col("m")
    return rows.select(
        "doc_id",
        M.field(m, "Policy").alias("policy"),
        M.field(m, "Document Type").alias("doc_type"),
        M.field(m, "Source").alias("source"),
        M.field(m, "1").alias("one"),
        (F.size(m) - F.when(M.field(m, "-------").isNotNull(), 1).otherwise(0))
        .cast("bigint").alias("n"),
    )


@query("c14_strip_pdf_metadata_table", _from(PDF_FILE_SQL, doc_id="doc_id", body=PDF_BODY_SQL))
def _(spark, sf):
    return seeds.pdf_files(spark, sf).select(
        "doc_id", M.strip_pdf_metadata_table(F.col("raw")).alias("body")
    )


@query(
    "c15_concat_pdf_sections",
    f"SELECT policy_slug AS slug, file, {d_strip(PDF_BODY_SQL)} AS detail FROM ({PDF_FILE_SQL}) "
    f"WHERE {d_strip(PDF_BODY_SQL)} <> ''",
)
def _(spark, sf):
    from corpusloom.operators.normalise import pdf_sections

    return pdf_sections(seeds.pdf_files(spark, sf))


def d_yaml(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"


@query("c16_frontmatter", _from(
    BLOG_SQL, doc_id="doc_id",
    fm="concat_ws(chr(10), '---', 'slug: \"' || slug || '\"', CASE WHEN lang <> 'en' THEN 'lang: \"' || "
    "lang || '\"' END, 'excerpt: \"' || " + d_yaml("raw") + " || '\"', CASE WHEN lang <> 'en' "
    "THEN 'tags: [\"' || lang || '\", \"' || source || '\"]' END, '---')",
))
def _(spark, sf):
    rows = seeds.blog_md(spark, sf)
    foreign = F.col("lang") != "en"
    return rows.select(
        "doc_id",
        M.frontmatter(
            [
                ("slug", F.col("slug")),
                ("lang", F.when(foreign, F.col("lang")).otherwise("")),
                ("absent", F.lit(None).cast("string")),
                ("excerpt", F.col("raw")),
                ("tags", F.when(foreign, F.array("lang", "source"))
                 .otherwise(F.array().cast("array<string>"))),
            ],
            lists=("tags",),
        ).alias("fm"),
    )


def d_q(x: str) -> str:
    return f"replace({x}, '\"', '\\\"')"


@query("c17_site_frontmatter", _from(
    BLOG_SQL, doc_id="doc_id",
    blog="concat_ws(chr(10), '---', 'title: \"Post ' || doc_id || '\"', 'slug: ' || slug, 'date: \"' || lang || '\"', "
    "'author: \"a \\\"q\\\" ' || source || '\"', '---')",
    policies="concat_ws(chr(10), '---', 'title: \"Post ' || doc_id || '\"', 'slug: ' || slug, "
    "'pdfDownloads:', '  - \"' || lang || '\"', '  - \"' || source || '\"', '---')",
    team="concat_ws(chr(10), '---', 'name: \"Post ' || doc_id || '\"', 'slug: ' || slug, 'role: \"' || lang || '\"', '---')",
))
def _(spark, sf):
    rows = seeds.blog_md(spark, sf).select(
        "doc_id", "slug", F.lit("").alias("title"), F.col("lang").alias("date"),
        F.concat(F.lit('a "q" '), "source").alias("author"), F.lit("").alias("source_url"),
        F.lit("").alias("ingested_at"), F.array("lang", "source").alias("pdf_urls"),
        F.lit(None).cast("string").alias("name"), F.col("lang").alias("role"),
        F.lit("").alias("electorate"),
    )
    named = rows.withColumn("title", F.concat(F.lit("Post "), F.col("doc_id").cast("string")))
    return named.select(
        "doc_id",
        M.site_frontmatter("blog").alias("blog"),
        M.site_frontmatter("policies").alias("policies"),
        M.site_frontmatter("team").alias("team"),
    )


@query("c18_strip_frontmatter", _from(
    "SELECT * FROM documents", doc_id="doc_id", body="text", block="text", bare="text",
))
def _(spark, sf):
    md = F.concat(F.lit('---\ntitle: "T '), F.col("doc_id").cast("string"), F.lit('"\n---\n'), "text")
    return table(spark, sf, "documents").select(
        "doc_id",
        M.strip_frontmatter(md).alias("body"),
        M.strip_frontmatter_block(md).alias("block"),
        M.strip_frontmatter(F.col("text")).alias("bare"),
    )


@query("c19_doc_title", _from(
    "SELECT * FROM documents", doc_id="doc_id", fm="'T ' || doc_id", h1="'H ' || doc_id", slug="source",
))
def _(spark, sf):
    key = F.col("doc_id").cast("string")
    fm = F.concat(F.lit('---\ntitle: "T '), key, F.lit('"\n---\n# X\n'), "text")
    h1 = F.concat(F.lit("intro\n# H "), key, F.lit("\n"), "text")
    return table(spark, sf, "documents").select(
        "doc_id",
        M.doc_title(fm, F.col("source")).alias("fm"),
        M.doc_title(h1, F.col("source")).alias("h1"),
        M.doc_title(F.col("text"), F.col("source")).alias("slug"),
    )


@query("c20_clean_profile_markdown", _from(
    "SELECT * FROM documents", doc_id="doc_id",
    md="'# N' || chr(10) || chr(10) || '## T' || chr(10) || chr(10) || " + d_rstrip("text"),
))
def _(spark, sf):
    md = F.concat(
        F.lit("# N\n\n## T\n\n# N\n\n## T\n\n"), "text",
        F.lit("\n\n\n[m [x@y]](/cdn-cgi/l/email-protection#1)\n\n### donate now\nplease"),
    )
    return table(spark, sf, "documents").select(
        "doc_id", M.clean_profile_markdown(md).alias("md")
    )


@query("c21_strip_redundant_headings", _from(
    MEMBER_SQL, c_custkey="c_custkey",
    md="'# ' || name || chr(10) || chr(10) || 'A' || chr(10) || chr(10) || '## About' || chr(10) || 'B'",
))
def _(spark, sf):
    name, area = F.col("name"), F.col("electorate")
    shout = F.when(area != "", F.concat(F.lit("#### "), F.upper(area), F.lit("\n\n"))).otherwise("")
    md = F.concat(
        shout, F.lit("# "), name, F.lit("\n\nA\n\n# **"), name, F.lit("**\n\n## **"), name,
        F.lit(" (Dr)**\nB\n"),
    )
    return seeds.members(spark, sf).select(
        "c_custkey", M.strip_redundant_headings(md, name, area).alias("md")
    )


@query("c22_strip_glyphs", _from("SELECT * FROM documents", doc_id="doc_id", text="text || 'oicers '"
                                 " || chr(57344) || ' x'"))
def _(spark, sf):
    dirty = F.concat(
        F.lit("​"), F.regexp_replace("text", "([aeiou])", "$1‍﻿"),
        F.lit("oicers  x"),
    )
    return table(spark, sf, "documents").select("doc_id", M.strip_glyphs(dirty).alias("text"))


_PDF_CLEAN = (
    "'## **1. Aims**' || chr(10) || chr(10) || "
    + d_unlines(f"list_transform({d_lines('text')}, lambda l: {d_rstrip('l')})")
    + " || chr(10) || chr(10) || '## **1.1 Steps.Then**' || chr(10) || chr(10) || '- a' || chr(10) || '- b' || "
    "chr(10) || chr(10) || '| A | B |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |'"
)


@query("c23_clean_pdf_body", _from(PDF_SQL, doc_id="doc_id", body=d_collapse(_PDF_CLEAN)))
def _(spark, sf):
    return seeds.pdf_raw(spark, sf).select("doc_id", M.clean_pdf_body(F.col("raw")).alias("body"))


@query("c24_pdf_header", _from(
    PDF_SQL, doc_id="doc_id", date="'January 2026'", policy="source", document_type="lang || ' paper'",
))
def _(spark, sf):
    rows = seeds.pdf_raw(spark, sf).withColumn("h", M.pdf_header(F.col("raw")))
    return rows.select(
        "doc_id", *[M.field(F.col("h"), k).alias(k) for k in ("date", "policy", "document_type")]
    )


@query("c25_format_pdf_markdown", _from(
    PDF_SQL, doc_id="doc_id",
    md="'# ' || CASE WHEN lang = 'fr' THEN 'Doc ' || doc_id WHEN lang = 'en' THEN source ELSE source || ' — ' || lang END || chr(10) || chr(10) || "
    "'| Field | Value |' || chr(10) || '|-------|-------|' || chr(10) || '| Date | May |' || chr(10) || "
    "CASE WHEN lang = 'fr' THEN '' ELSE '| Policy | ' || source || ' |' || chr(10) END || "
    "CASE WHEN lang = 'fr' THEN '' WHEN lang = 'en' THEN '| Document Type | Policy Overview |' || chr(10) ELSE '| Document Type | ' || lang || ' |' || chr(10) END || "
    "'| Source | `d_' || doc_id || '.pdf` |' || chr(10) || chr(10) || text || chr(10)",
))
def _(spark, sf):
    key = F.col("doc_id").cast("string")
    none = F.col("lang") == "fr"
    kind = F.when(none, "").when(F.col("lang") == "en", "Policy Overview").otherwise(F.col("lang"))
    return seeds.pdf_raw(spark, sf).select(
        "doc_id",
        M.format_pdf_markdown(
            F.lit("May"), F.when(none, "").otherwise(F.col("source")), kind, F.col("text"),
            F.concat(F.lit("d_"), key, F.lit(".pdf")), F.concat(F.lit("doc-"), key),
        ).alias("md"),
    )


@query("c26_format_party_pdf", _from(
    EVENT_SQL, event_id="event_id",
    md="'# ' || " + d_title("replace(slug, '-', ' ')") + " || chr(10) || chr(10) || '> **Source**: u/' || user_id || chr(10) || chr(10) || "
    + d_strip(d_collapse("raw")) + " || chr(10)",
))
def _(spark, sf):
    return seeds.event_md(spark, sf).select(
        "event_id",
        M.format_party_pdf(
            F.col("slug"), F.concat(F.lit("u/"), F.col("user_id").cast("string")), F.col("raw")
        ).alias("md"),
    )


@query(
    "c27_inject_sections",
    "SELECT policy_slug AS slug, file, 'Base of ' || policy_slug AS base, chr(10) || chr(10) || '---' || chr(10) || chr(10) || "
    f"'# ' || file || chr(10) || {d_strip('text')} AS md FROM ({PDF_FILE_SQL})",
)
def _(spark, sf):
    docs = seeds.pdf_files(spark, sf).select(
        F.col("policy_slug").alias("slug"), "file",
        F.concat(F.lit("\n\n---\n\n# "), "file", F.lit("\n"), X.strip(F.col("text"))).alias("md"),
    )
    old = F.concat(F.lit("Base of "), "slug", F.lit(" \n\n---\n\n# old\nstale"))
    return docs.select("slug", "file", M.section_base(old).alias("base"), "md")


@query(
    "c28_format_records_md",
    "SELECT 'p' || page_id AS k, raw2 AS md FROM (SELECT page_id, '# ' || title || chr(10) || chr(10) || '> **URL**: ' || url || "
    f"chr(10) || '> **Scraped**: s' || chr(10) || chr(10) || html || chr(10) AS raw2 FROM ({POLICY_SQL}) JOIN (SELECT page_id, html FROM pages) USING (page_id)) UNION ALL "
    "SELECT 'i' || page_id, '# ' || " + d_title("'sec ' || page_id || ' x'") + " || chr(10) || chr(10) || '> **URL**: ' || url || "
    "chr(10) || '> **Scraped**: s' || chr(10) || chr(10) || html || chr(10) FROM pages UNION ALL "
    "SELECT 'b' || doc_id, '**Title**: ' || source || chr(10) || CASE WHEN lang <> 'en' THEN '**Date**: ' || lang || chr(10) ELSE '' END || "
    "'**URL**: u' || chr(10) || '**Scraped**: s' || chr(10) || chr(10) || text || chr(10) FROM documents UNION ALL "
    "SELECT 'e' || doc_id, '**Title**: ' || source || chr(10) || CASE WHEN lang <> 'en' THEN '**Date**: ' || lang || chr(10) ELSE '' END || "
    "'**Location**: L' || chr(10) || '**URL**: u' || chr(10) || '**Scraped**: s' || chr(10) || chr(10) || text || chr(10) FROM documents UNION ALL "
    "SELECT 'm' || c_custkey, '# ' || name || chr(10) || chr(10) || '**Role**: ' || role || chr(10) || CASE WHEN electorate <> '' THEN "
    "'**Electorate**: ' || electorate || chr(10) ELSE '' END || chr(10) || '> **URL**: ' || url || chr(10) || '> **Scraped**: s' || chr(10) || chr(10) || "
    f"'## About' || chr(10) || 'x' || chr(10) FROM ({MEMBER_SQL})",
)
def _(spark, sf):
    def key(prefix: str, c: str):
        return F.concat(F.lit(prefix), F.col(c).cast("string")).alias("k")

    s, u, lang = F.lit("s"), F.lit("u"), F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    pages = table(spark, sf, "pages").select("page_id", "html")
    policies = seeds.policy_md(spark, sf).join(pages, "page_id").select(
        key("p", "page_id"),
        M.policy_md(F.col("title"), F.col("url"), s, F.col("html")).alias("md"),
    )
    section = F.concat(F.lit("sec-"), F.col("page_id").cast("string"), F.lit("-x"))
    info = table(spark, sf, "pages").select(
        key("i", "page_id"), M.info_md(section, F.col("url"), s, F.col("html")).alias("md")
    )
    docs = table(spark, sf, "documents")
    blog = docs.select(
        key("b", "doc_id"),
        M.blog_md(F.col("source"), lang, F.lit(""), u, s, F.col("text")).alias("md"),
    )
    events = docs.select(
        key("e", "doc_id"),
        M.event_md(F.col("source"), lang, F.lit(""), F.lit("L"), u, s, F.col("text")).alias("md"),
    )
    bio = F.concat(F.lit("## "), "name", F.lit("\nx"))
    people = seeds.members(spark, sf).select(
        key("m", "c_custkey"),
        M.member_md(F.col("name"), F.col("role"), F.col("electorate"), F.col("url"), s, bio).alias("md"),
    )
    return policies.unionByName(info).unionByName(blog).unionByName(events).unionByName(people)


def d_summary(x: str, n: int) -> str:
    p = d_sub(x, r"(?m)^#+\s+", "")
    p = f"replace({p}, '*', '')"
    p = d_sub(p, r"\[([^\]]+)\]\([^)]+\)", r"\1")
    p = d_strip(d_sub(p, r"(?m)^[>-]\s*", ""))
    words = f"regexp_split_to_array({p}, '\\s+')"
    return (
        f"array_to_string({words}[1:{n}], ' ') || CASE WHEN len({words}) > {n} THEN '…' ELSE '' END"
    )


@query("c29_summary", _from(
    BLOG_SQL, doc_id="doc_id", long=d_summary("raw", 200), short=d_summary("raw", 20),
))
def _(spark, sf):
    return seeds.blog_md(spark, sf).select(
        "doc_id", M.summary(F.col("raw"), 200).alias("long"), M.summary(F.col("raw"), 20).alias("short")
    )


@query("c30_absolutize_links", _from(
    "SELECT * FROM documents", doc_id="doc_id", n="(1 + CASE WHEN lang = 'en' THEN 1 ELSE 0 END)::bigint",
    md="text || '[a](https://x.org/p/' || doc_id || ') [b](http://q)' || CASE WHEN lang = 'en' THEN '[c](https://x.org/en)' ELSE '' END",
))
def _(spark, sf):
    md = F.concat(
        "text", F.lit("[a](/p/"), F.col("doc_id").cast("string"), F.lit(") [b](http://q)"),
        F.when(F.col("lang") == "en", "[c](/en)").otherwise(""),
    )
    out, n = M.absolutize_links(md, "https://x.org//")
    return table(spark, sf, "documents").select(
        "doc_id", out.alias("md"), n.cast("bigint").alias("n")
    )


# --- repair rules -----------------------------------------------------------

_DOCS = "SELECT * FROM documents"


def _doc_text(spark, sf, *before, after=()):
    parts = [F.lit(x) if isinstance(x, str) else x for x in (*before, F.col("text"), *after)]
    return table(spark, sf, "documents").withColumn("md", F.concat(*parts))


@query("q01_space_after_period", _from(
    _DOCS, doc_id="doc_id", text=d_sub("replace(text, '. ', '.')", r"\.([A-Z])", r". \1"),
))
def _(spark, sf):
    squeezed = F.replace("text", F.lit(". "), F.lit("."))
    return table(spark, sf, "documents").select(
        "doc_id", Q.space_after_period(squeezed).alias("text")
    )


@query("q02_merge_split_headings", _from(
    _DOCS, doc_id="doc_id", text="'## **Why (this) and that?**' || chr(10) || text || chr(10) || '## **Why (this)**'",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, "## **Why (this)**\n\n## **and that?**\n", after=("\n## **Why (this)**",))
    return rows.select(
        "doc_id", Q.merge_split_headings(F.col("md"), [("Why (this)", "and that?")]).alias("text")
    )


@query("q03_demote_subnumbering", _from(
    _DOCS, doc_id="doc_id",
    text="'## **1. A**' || chr(10) || '### **1.1 B**' || chr(10) || text || chr(10) || '### **12.3 C**' || chr(10) || '## 1.2 D'",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, "## **1. A**\n## **1.1 B**\n", after=("\n## **12.3 C**\n## 1.2 D",))
    return rows.select("doc_id", Q.demote_subnumbering(F.col("md")).alias("text"))


@query("q04_demote_faq", _from(
    _DOCS, doc_id="doc_id",
    text="'## **A**' || chr(10) || text || chr(10) || '## **X—Frequently Asked Questions**' || chr(10) || '### **Q?**' || chr(10) || text || chr(10) || '### **R?**'",
))
def _(spark, sf):
    rows = _doc_text(
        spark, sf, "## **A**\n",
        after=("\n## **X—Frequently Asked Questions**\n## **Q?**\n", F.col("text"), "\n## **R?**"),
    )
    return rows.select("doc_id", Q.demote_faq(F.col("md")).alias("text"))


_WRAP = "## **The problems we’re solving**\n\n"


@query("q05_demote_under_wrapper", _from(
    _DOCS, doc_id="doc_id",
    text=lit(_WRAP) + " || '### **One**' || chr(10) || text || chr(10) || '### **Two**' || chr(10) || 'x' || chr(10) || CASE doc_id % 4 "
    "WHEN 0 THEN '## **1. Num**' WHEN 1 THEN '## **Our reforms:**' WHEN 2 THEN '## **How?**' ELSE '## **Pillars**' || chr(10) || chr(10) || '## **1. Go**' END "
    "|| chr(10) || 'y' || chr(10) || '## **Three**'",
))
def _(spark, sf):
    stop = (
        F.when(F.col("doc_id") % 4 == 0, "## **1. Num**")
        .when(F.col("doc_id") % 4 == 1, "## **Our reforms:**")
        .when(F.col("doc_id") % 4 == 2, "## **How?**")
        .otherwise("## **Pillars**\n\n## **1. Go**")
    )
    rows = _doc_text(
        spark, sf, _WRAP + "## **One**\n", after=("\n## **Two**\nx\n", stop, "\ny\n## **Three**")
    )
    return rows.select("doc_id", Q.demote_under_wrapper(F.col("md")).alias("text"))


@query("q06_restore_ligatures", _from(
    _DOCS, doc_id="doc_id",
    text="text || ' The officers and Committees of the office had a letter from the committee; a voice, coherent, leer at.'",
))
def _(spark, sf):
    rows = _doc_text(
        spark, sf,
        after=(" The oicers and Commiees of the oice had a leer from the commiee; a voice, coherent, leer at.",),
    )
    return rows.select("doc_id", Q.restore_ligatures(F.col("md")).alias("text"))


_PIC = ("**----- Start of picture text -----**<br>\n", "<br>**----- End of picture text -----**<br>\n")


@query("q07_drop_picture_block", _from(
    _DOCS, doc_id="doc_id", text="text || chr(10) || " + lit(_PIC[0]) + " || 'keep' || " + lit(_PIC[1]) + " || 'end'",
))
def _(spark, sf):
    rows = _doc_text(
        spark, sf,
        after=("\n" + _PIC[0] + "Big (art)<br>x" + _PIC[1] + _PIC[0] + "keep" + _PIC[1] + "end",),
    )
    return rows.select("doc_id", Q.drop_picture_block(F.col("md"), "(art)<br>").alias("text"))


@query("q08_fix_table_cells", _from(
    _DOCS, doc_id="doc_id",
    text="text || chr(10) || '|A|\\$m|-|' || chr(10) || '|---|---|---|' || chr(10) || '|1|-| |' || chr(10) || '|2|\\$m|-|' || chr(10) || '||Toc...1|' || chr(10) || '|3||4|' || chr(10) || 'x'",
))
def _(spark, sf):
    rows = _doc_text(
        spark, sf,
        after=("\n|A|$m||\n|---|---|---|\n|1|| |\n|2|\\$m||\n||Toc...1|\n|3||4|\nx",),
    )
    return rows.select("doc_id", Q.fix_table_cells(F.col("md")).alias("text"))


@query("q09_drop_running_label", _from(
    _DOCS, doc_id="doc_id", text="text || chr(10) || chr(10) || 'tail'",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, after=("\n\n**Oceans**\n\ntail",))
    return rows.select("doc_id", Q.drop_running_label(F.col("md"), "Oceans").alias("text"))


@query("q10_promote_bold_heading", _from(
    _DOCS, doc_id="doc_id", text="text || chr(10) || '## **1.3 Do it**' || chr(10) || 'in **1.3 Do it** run'",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, after=("\n**1.3 Do it**\nin **1.3 Do it** run",))
    once = Q.promote_bold_heading(F.col("md"), "1.3 Do it")
    return rows.select("doc_id", Q.promote_bold_heading(once, "1.3 Do it").alias("text"))


@query("q11_drop_duplicate_header", _from(
    _DOCS, doc_id="doc_id", text="'head' || chr(10) || chr(10) || text",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, "head\nDocument Type **Policy Addendum**\n\n")
    return rows.select("doc_id", Q.drop_duplicate_header(F.col("md")).alias("text"))


@query("q12_drop_orphan_heading", _from(
    _DOCS, doc_id="doc_id", text="text || chr(10) || 'desirability of a pan-sector vision goes on' || chr(10) || '##'",
))
def _(spark, sf):
    rows = _doc_text(spark, sf, after=("\n## \n\ndesirability of a pan-sector vision goes on\n##",))
    return rows.select("doc_id", Q.drop_orphan_heading(F.col("md")).alias("text"))


@query("q13_merge_policy_headings", _from(
    _DOCS, doc_id="doc_id",
    text=lit(f"## **{' '.join(rules.SPLIT_HEADINGS[0])}**") + " || chr(10) || "
    + d_sub("text || '.Then'", r"\.([A-Z])", r". \1"),
))
def _(spark, sf):
    first, second = rules.SPLIT_HEADINGS[0]
    rows = _doc_text(spark, sf, f"## **{first}**\n\n## **{second}**\n", after=(".Then",))
    return rows.select("doc_id", Q.merge_policy_headings(F.col("md")).alias("text"))


_RULE_KEY = (
    "CASE doc_id % 4 WHEN 0 THEN 'pdf-policy-overview.md' WHEN 1 THEN 'pdf-policy-addendum.md' "
    "WHEN 2 THEN 'pdf-default.md' ELSE 'pdf-other.md' END"
)
_RULED = (
    "CASE WHEN doc_id % 4 IN (0, 1) THEN " + d_sub("text || chr(10) || 'needed.Those oicers'", r"\.([A-Z])", r". \1")
    + " WHEN doc_id % 4 = 2 THEN text || chr(10) || 'needed.Those officers' ELSE text || chr(10) || 'needed.Those oicers' END"
)


def _ruled(spark, sf):
    n = F.col("doc_id") % 4
    key = (
        F.when(n == 0, "pdf-policy-overview.md").when(n == 1, "pdf-policy-addendum.md")
        .when(n == 2, "pdf-default.md").otherwise("pdf-other.md")
    )
    rows = _doc_text(spark, sf, after=("\nneeded.Those oicers",)).withColumn("rule_key", key)
    return rows.withColumn("patched", Q.apply_rules(F.col("rule_key"), F.col("md")))


@query("q14_apply_rules", _from(_DOCS, doc_id="doc_id", rule_key=_RULE_KEY, text=_RULED))
def _(spark, sf):
    return _ruled(spark, sf).select("doc_id", "rule_key", F.col("patched").alias("text"))


@query("q15_patched_report",
       "SELECT source, count(*) AS patch_count FROM documents WHERE doc_id % 4 <> 3 GROUP BY source")
def _(spark, sf):
    return G.patched_report(_ruled(spark, sf), "source", "md", "patched")


@query("q15_patched_files", "SELECT source, doc_id FROM documents WHERE doc_id % 4 <> 3")
def _(spark, sf):
    return G.patched_files(_ruled(spark, sf), "md", "patched").select("source", "doc_id")


@query("q16_replace_picture_blocks", _from(
    _DOCS, doc_id="doc_id", n="3::bigint",
    md="text || chr(10) || '![img-1-' || doc_id || '](images/img-1-' || doc_id || '.png)' || chr(10) || chr(10) || 'mid' || chr(10) || '![b](images/b.jpg)' || chr(10) || chr(10) || 'end'",
))
def _(spark, sf):
    def pic(t):
        return _PIC[0] + t + _PIC[1]

    rows = _doc_text(spark, sf, after=("\n" + pic("a") + "mid\n" + pic("b") + pic("c") + "end",))
    files = F.array(
        F.concat(F.lit("img-1-"), F.col("doc_id").cast("string"), F.lit(".png")), F.lit("b.jpg")
    )
    md, n = Q.replace_picture_blocks(F.col("md"), files, F.lit("images"))
    return rows.select("doc_id", md.alias("md"), n.cast("bigint").alias("n"))


# --- validation metrics -----------------------------------------------------


@query("v01_normalise_compare", _from(_DOCS, doc_id="doc_id", text="strip_accents(text) || ' office 12'"))
def _(spark, sf):
    odd = F.when(F.col("doc_id") % 2 == 0, " oﬃce ①²").otherwise(" office 12")
    return table(spark, sf, "documents").select(
        "doc_id", V.normalise_compare(F.concat("text", odd)).alias("text")
    )


_TOK = "regexp_extract_all(strip_accents(text), '[A-Za-z0-9]+')"


@query("v02_tokens", _from(
    _DOCS, doc_id="doc_id", tokens=f"array_to_string({_TOK}, ' ')", n=f"len({_TOK})",
    words=f"array_to_string(list_sort(list_distinct(list_transform({_TOK}, lambda w: lower(w)))), ' ')",
))
def _(spark, sf):
    rows = V.with_tokens(table(spark, sf, "documents"), {"t": "text"})
    return rows.select(
        "doc_id",
        F.array_join("t", " ").alias("tokens"),
        F.size("t").cast("bigint").alias("n"),
        F.array_join(F.sort_array(V.unique_words(F.col("t"))), " ").alias("words"),
    )


@query("v04_structural_stats", _from(
    PDF_SQL, doc_id="doc_id", headings="len(regexp_extract_all(raw, '(?m)^#{1,6}\\s'))",
    table_rows="len(regexp_extract_all(raw, '(?m)^\\|'))", bullets="len(regexp_extract_all(raw, '(?m)^- '))",
))
def _(spark, sf):
    raw = F.col("raw")
    return seeds.pdf_raw(spark, sf).select(
        "doc_id",
        V.headings(raw).cast("bigint").alias("headings"),
        V.table_rows(raw).cast("bigint").alias("table_rows"),
        V.bullets(raw).cast("bigint").alias("bullets"),
    )


@query("v05_glyph_artefacts", _from(
    _DOCS, doc_id="doc_id", n="len(regexp_extract_all(text, '[A-Za-z]e'))::bigint",
))
def _(spark, sf):
    dirty = F.regexp_replace("text", "([A-Za-z])e", "$1​")
    return table(spark, sf, "documents").select(
        "doc_id", V.glyph_artefacts(dirty).cast("bigint").alias("n")
    )


_SNIP = d_sub(
    d_strip(d_sub(d_strip(
        "list_filter(" + d_lines("text") + ", lambda l: " + d_strip("l") + " <> '' AND NOT contains(lower(l), 'picture'))[1]"
    ), "[#*`_]", "")), r"\s+", " ",
)


@query("v08_snippet_in_render", _from(
    _DOCS, doc_id="doc_id", snippet=_SNIP, found=f"contains({d_sub(d_sub('text', '[#*`_]', ''), chr(92) + 's+', ' ')}, {_SNIP})",
))
def _(spark, sf):
    md = F.concat(F.lit("| t |\n![i](x)\n<!-- c -->\n\n"), "text")
    rendered = F.concat(F.lit("t "), F.regexp_replace("text", "[#*`_]", ""))
    return table(spark, sf, "documents").select(
        "doc_id",
        V.render_snippet(md).alias("snippet"),
        V.snippet_in_render(md, rendered).alias("found"),
    )


# --- scalars ----------------------------------------------------------------


@query("x01_title_slug", _from(
    POLICY_SQL, page_id="page_id",
    slug="left(" + d_sub("replace(trim(" + d_sub("lower(title)", r"[^a-z0-9\- ]") + "), ' ', '-')", "-{2,}", "-") + ", 80)",
))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select("page_id", X.title_slug(F.col("title")).alias("slug"))


@query("x02_doc_type_slug", _from(
    _DOCS, doc_id="doc_id",
    slug="trim(" + d_sub("replace(" + d_sub("replace(" + d_strip("lower(text)") + ", '''', '')", r"[^a-z0-9\- ]") + ", ' ', '-')", "-{2,}", "-") + ", '-')",
))
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.doc_type_slug(F.col("text")).alias("slug")
    )


# File names as urls give them: host and path with blanks for slashes, their length as it comes.
_FILE_SQL = "SELECT page_id, replace(replace(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/', ' '), '_', ' ') AS name FROM pages"
_STEM = "trim(replace(replace(lower(name), '.pdf', ''), ' ', '-'), '-')"


@query("x03_slug_from_filename", _from(
    _FILE_SQL, page_id="page_id",
    slug=f"CASE WHEN length({_STEM}) <= 30 AND regexp_matches({_STEM}, '[a-z]') THEN {_STEM} END",
    digits="CASE WHEN page_id < 0 THEN '' END",
    stem=_STEM,
))
def _(spark, sf):
    host = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    name = F.replace(F.replace(host, F.lit("/"), F.lit(" ")), F.lit("_"), F.lit(" "))
    full = F.concat(F.lit("_migrated_Brand_Policy_"), name, F.lit("_Overview.pdf"))
    short = F.concat(F.lit("Brand_"), name, F.lit("_Overview.pdf"))
    number = F.concat(F.lit("12-"), F.col("page_id").cast("string"), F.lit("_x.pdf"))
    return table(spark, sf, "pages").select(
        "page_id",
        X.slug_from_filename(full).alias("slug"),
        X.slug_from_filename(number).alias("digits"),
        X.filename_stem_slug(short).alias("stem"),
    )


@query("x04_path_name_slug", _from(
    MEMBER_SQL, c_custkey="c_custkey", path="slug",
    name="left(trim(" + d_sub(d_sub("replace(replace(lower(name || '/' || segment || ' é'), ' ', '-'), '/', '-')", "[^a-z0-9-]"), "-{2,}", "-") + ", '-'), 60)",
))
def _(spark, sf):
    return seeds.members(spark, sf).select(
        "c_custkey",
        X.path_slug(F.concat(F.lit("/candidate-"), "slug", F.lit("/"))).alias("path"),
        X.name_slug(F.concat("name", F.lit("/"), "segment", F.lit(" é"))).alias("name"),
    )


@query("x05_slug_title", _from(
    _DOCS, doc_id="doc_id", title=d_title("replace(text || '-o''neil', '-', ' ')"),
))
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.slug_title(F.concat("text", F.lit("-o'neil"))).alias("title")
    )


@query("x06_media_slug", _from(
    _DOCS, doc_id="doc_id",
    slug="left(trim(" + d_sub(d_sub(d_sub("lower(text)", r"[^\p{L}\p{N}_\s-]"), r"[\s_]+", "-"), "-+", "-") + ", '-'), 80)",
))
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.media_slug(F.col("text")).alias("slug")
    )


@query("x07_label_slug", _from(
    POLICY_SQL, page_id="page_id",
    slug="trim(" + d_sub("replace(lower(title), ' ', '-')", "[^a-z0-9-]") + ", '-')",
))
def _(spark, sf):
    return seeds.policy_md(spark, sf).select("page_id", X.label_slug(F.col("title")).alias("slug"))


@query("x08_rfc822_date",
       "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, '' AS bad FROM events")
def _(spark, sf):
    stamp = F.concat(
        F.lit("Mon, "), F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" +1200")
    )
    return table(spark, sf, "events").select(
        "event_id",
        X.rfc822_date(stamp).alias("date"),
        X.rfc822_date(F.concat(F.lit("x"), stamp)).alias("bad"),
    )


@query("x09_now_iso", "SELECT event_id, true AS is_iso, true AS is_now, (SELECT count(*) > 0 FROM events) AS is_one FROM events")
def _(spark, sf):
    """Rows stamped with the time of the run: of ISO form, between start and end, the same for all."""
    start = dt.datetime.now(dt.UTC).replace(microsecond=0)
    rows = table(spark, sf, "events").select("event_id", X.now_iso().alias("cleaned_at"))
    stamp, now = F.col("cleaned_at"), F.current_timestamp()
    return rows.select(
        "event_id", stamp.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$").alias("is_iso"),
        F.to_timestamp(stamp).between(F.lit(start), now).alias("is_now"),
        (stamp == X.now_iso()).alias("is_one"),
    )


@query("x10_format_age",
       "SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' ELSE "
       "(s // 3600) || 'h' || (s % 3600 // 60) || 'm' END AS age FROM (SELECT event_id, "
       "(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(ts)))::bigint % 90000 // "
       "CASE WHEN event_id % 3 = 0 THEN 1000 ELSE 1 END AS s FROM events)")
def _(spark, sf):
    seconds = F.lit(1706659200) - F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    capped = F.floor(
        (seconds % 90000) / F.when(F.col("event_id") % 3 == 0, 1000).otherwise(1)
    )
    return table(spark, sf, "events").select("event_id", X.format_age(capped).alias("age"))


@query("x11_video_label",
       "SELECT event_id, event_type || CASE WHEN user_id = 0 THEN '' ELSE "
       "'  [' || (user_id * 7 // 60) || ':' || lpad((user_id * 7 % 60)::varchar, 2, '0') || ']' END || "
       "CASE WHEN event_id % 2 = 0 THEN ' [short]' ELSE '' END AS label FROM events")
def _(spark, sf):
    tab = F.when(F.col("event_id") % 2 == 0, "shorts").otherwise("videos")
    return table(spark, sf, "events").select(
        "event_id", X.video_label(F.col("event_type"), F.col("user_id") * 7, tab).alias("label")
    )


@query("x12_hashes", "SELECT doc_id, md5(text) AS md5, left(sha256(text), 16) AS url_key FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5("text").alias("md5"), X.url_key(F.col("text")).alias("url_key")
    )


@query("x13_media_defaults",
       "SELECT event_id, '' AS upload_date, 'videos' AS tab, json_extract_string(props, '$.k')::bigint AS duration, "
       "NULL::bigint AS view_count FROM events")
def _(spark, sf):
    from corpusloom.sources.readers import media_defaults

    json = F.replace("props", F.lit('"k"'), F.lit('"duration"'))
    fields = media_defaults(json)
    return table(spark, sf, "events").select(
        "event_id", *[fields[n].alias(n) for n in ("upload_date", "tab", "duration", "view_count")]
    )


@query("x14_is_pdf_bytes", "SELECT doc_id, doc_id % 3 = 0 AS is_pdf FROM documents")
def _(spark, sf):
    head = F.when(F.col("doc_id") % 3 == 0, "%PDF-1.7\n").when(F.col("doc_id") % 3 == 1, "%PD").otherwise("")
    content = F.when(F.col("doc_id") % 3 == 2, F.lit("").cast("binary")).otherwise(
        F.concat(head, "text").cast("binary")
    )
    return table(spark, sf, "documents").select("doc_id", X.is_pdf_bytes(content).alias("is_pdf"))


@query("x15_yaml_escape", _from(
    _DOCS, doc_id="doc_id", full=d_yaml("text || ' \"q\" \\ '"), quotes=d_q("text || ' \"q\" \\ '"),
))
def _(spark, sf):
    t = F.concat("text", F.lit(' "q" \\ '))
    return table(spark, sf, "documents").select(
        "doc_id", X.yaml_escape(t).alias("full"), X.quote_escape(t).alias("quotes")
    )
