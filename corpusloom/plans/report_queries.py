"""Queries over items and results: validation, reports, listings, faceted search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import rules, schemas
from corpusloom.functions import html as H
from corpusloom.operators import find as FD
from corpusloom.operators import registry as R
from corpusloom.operators import reports as G
from corpusloom.operators import validate as VA
from corpusloom.operators.scale import down, nth_rows, numbered, up
from corpusloom.plans import seeds
from corpusloom.plans.book import d_element, d_text, query, table
from corpusloom.plans.item_queries import (
    R02_SQL,
    R03_SQL,
    S16_SQL,
    _YEAR,
    indexed_store,
    media,
    scratch,
    stored,
)
from corpusloom.plans.seeds import (
    AS_OF,
    BLOG_SQL,
    CLEANED_AT,
    EVENT_SQL,
    MEMBER_SQL,
    POLICY_PDF_SQL,
    REGISTRY_SQL,
)
from corpusloom.plans.text_queries import d_summary
from corpusloom.sources import writers

# --- validation -------------------------------------------------------------

# Two extractions of a page: the whole body's text, and the article as markdown.
_RAW = d_text(d_element("html", "body"), "chr(10)")
_MD = (
    "CASE WHEN page_id % 3 = 0 THEN '## **H**' || chr(10) ELSE '' END || "
    + d_text(d_element("html", "article"), "chr(10)")
    + " || CASE WHEN page_id % 4 = 0 THEN ' ' || array_to_string(list_filter(regexp_extract_all("
    + _RAW + ", '[^ ]+'), lambda w: true), ' ') ELSE '' END"
)
PAIR_SQL = (
    f"SELECT page_id, 'p' || page_id || '.pdf' AS filename, CASE WHEN page_id % 17 = 0 THEN NULL ELSE {_RAW} END AS raw_text, "
    f"{_MD} AS raw_md FROM pages"
)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    html = F.col("html")
    base = table(spark, sf, "pages").select(
        "page_id",
        H.html_text(H.element(html, "body"), "\n").alias("whole"),
        H.html_text(H.element(html, "article"), "\n").alias("main"),
    )
    head = F.when(F.col("page_id") % 3 == 0, "## **H**\n").otherwise("")
    words = F.array_join(F.regexp_extract_all("whole", F.lit("[^ ]+"), F.lit(0)), " ")
    tail = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit(" "), words)).otherwise("")
    return base.select(
        "page_id",
        F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.when(F.col("page_id") % 17 != 0, F.col("whole")).alias("raw_text"),
        F.concat(head, "main", tail).alias("raw_md"),
    )


_TOKENS = (
    "SELECT *, regexp_extract_all(strip_accents(raw_text), '[A-Za-z0-9]+') AS rt, "
    f"regexp_extract_all(strip_accents(raw_md), '[A-Za-z0-9]+') AS mt FROM ({PAIR_SQL})"
)
_UNIQUE = (
    "SELECT *, list_distinct(list_transform(rt, lambda w: lower(w))) AS ru, "
    f"list_distinct(list_transform(mt, lambda w: lower(w))) AS mu FROM ({_TOKENS})"
)
_COVER = (
    "SELECT *, CASE WHEN len(ru) = 0 THEN 0.0::double ELSE len(list_intersect(ru, mu)) / len(ru) END AS coverage "
    f"FROM ({_UNIQUE})"
)


@query(
    "v03_word_coverage",
    "SELECT page_id, round(coverage, 9) AS coverage, len(rt) AS raw_tokens, len(mt) AS md_tokens, len(ru) AS raw_unique, len(mu) AS md_unique "
    f"FROM ({_COVER})",
)
def _(spark, sf):
    stats = VA.word_stats(pairs(spark, sf))
    return stats.select(
        "page_id",
        F.round("coverage", 9).alias("coverage"),
        F.col("pymupdf_words").alias("raw_tokens"),
        F.col("markdown_words").alias("md_tokens"),
        F.col("unique_words_pymupdf").alias("raw_unique"),
        F.col("unique_words_markdown").alias("md_unique"),
    )


VALID_SQL = (
    "SELECT filename, CASE WHEN bad THEN 0 ELSE len(rt) END AS pymupdf_words, CASE WHEN bad THEN 0 ELSE len(mt) END AS markdown_words, "
    "CASE WHEN bad THEN 0 ELSE len(ru) END AS unique_words_pymupdf, CASE WHEN bad THEN 0 ELSE len(mu) END AS unique_words_markdown, "
    "CASE WHEN bad THEN 0.0::double ELSE round(coverage, 4) END AS word_coverage, CASE WHEN bad THEN 0 ELSE h END AS headings, "
    "0::bigint AS table_rows, 0::bigint AS bullets, NOT bad AND coverage >= 0.95 AS passed, CASE WHEN bad THEN 'exception during validation: missing extraction' "
    "ELSE concat_ws('; ', CASE WHEN coverage < 0.95 THEN 'word coverage ' || printf('%.3f', coverage) || ' < threshold 0.95' END, "
    "CASE WHEN len(rt) >= 500 AND h = 0 THEN 'no headings detected in markdown body' END) END AS notes "
    "FROM (SELECT *, raw_text IS NULL AS bad, CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END::bigint AS h "
    f"FROM ({_COVER}))"
)


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return VA.validate(pairs(spark, sf))


@query("v06_validate", VALID_SQL)
def _(spark, sf):
    rows = VA.validate(pairs(spark, sf))
    return rows.withColumn("notes", F.array_join("notes", "; "))


@query("v07_validate_all", VALID_SQL)
def _(spark, sf):
    return validated(spark, sf).withColumn("notes", F.array_join("notes", "; "))


@query(
    "g22_validation_summary",
    "SELECT 0.95::double AS threshold, count(*) AS pdf_count, count(*) FILTER (passed) AS passed_count, "
    f"count(*) FILTER (NOT passed) AS failed_count FROM ({VALID_SQL})",
)
def _(spark, sf):
    return VA.validation_summary(validated(spark, sf))


@query(
    "s14_write_validation",
    "SELECT filename, '{\"filename\":\"' || filename || '\",\"pymupdf_words\":' || pymupdf_words || ',\"markdown_words\":' || markdown_words || "
    "',\"unique_words_pymupdf\":' || unique_words_pymupdf || ',\"unique_words_markdown\":' || unique_words_markdown || ',\"word_coverage\":' || word_coverage || "
    "',\"headings\":' || headings || ',\"table_rows\":0,\"bullets\":0,\"passed\":' || passed || ',\"notes\":[' || "
    "CASE WHEN notes = '' THEN '' ELSE '\"' || replace(notes, '; ', '\",\"') || '\"' END || ']}' AS json "
    f"FROM ({VALID_SQL})",
)
def _(spark, sf):
    return VA.validation_json(validated(spark, sf))


@query(
    "s14_validation_round_trip",
    "SELECT pdf_count, passed_count, failed_count, filename, word_coverage, passed, notes FROM "
    f"(SELECT count(*) AS pdf_count, count(*) FILTER (passed) AS passed_count, count(*) FILTER (NOT passed) AS failed_count FROM ({VALID_SQL})), ({VALID_SQL})",
)
def _(spark, sf):
    """Header and results written as JSON files and read again."""
    path = scratch(spark, "validation")
    writers.write_validation(validated(spark, sf), path)
    back = writers.load_validation(spark, path)
    head = back["summary"].first()
    return back["results"].select(
        *[F.lit(head[c]).cast("bigint").alias(c) for c in ("pdf_count", "passed_count", "failed_count")],
        "filename", "word_coverage", "passed", F.array_join("notes", "; ").alias("notes"),
    )


@query(
    "g26_quality_report",
    "SELECT filename, '| `' || filename || '` | ' || format('{:,}', pymupdf_words) || ' | ' || format('{:,}', markdown_words) || ' | ' || "
    "printf('%.1f%%', word_coverage * 100) || ' | ' || headings || ' | 0 | 0 | ' || CASE WHEN passed THEN '✅ pass' ELSE '⚠️ fail' END || ' |' AS line, "
    f"CASE WHEN notes <> '' THEN '- **`' || filename || '`**: ' || notes END AS notes_line FROM ({VALID_SQL})",
)
def _(spark, sf):
    return G.quality_report(validated(spark, sf))


# --- counts and reports -----------------------------------------------------


@query("g20_item_counts", "SELECT lang, count(*) AS items FROM documents GROUP BY lang")
def _(spark, sf):
    return G.item_counts(table(spark, sf, "documents"), "lang")


_STATUS = (
    "CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'failed' WHEN 'error' THEN 'error' "
    "WHEN 'signup' THEN 'skipped' ELSE 'deduplicated' END"
)


@query(
    "g21_status_counts",
    "SELECT status, count(*) AS n, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status IN ('failed', 'error')) AS failed "
    f"FROM (SELECT {_STATUS} AS status FROM events) GROUP BY status",
)
def _(spark, sf):
    k = F.col("event_type")
    status = (
        F.when(k == "view", "ok").when(k == "click", "failed").when(k == "error", "error")
        .when(k == "signup", "skipped").otherwise("deduplicated")
    )
    return G.status_counts(table(spark, sf, "events").select(status.alias("status")))


_REG2 = f"SELECT 'pol-' || ord % 30 AS policy_slug, filename FROM ({REGISTRY_SQL})"


def _registry2(spark: SparkSession, sf: str) -> DataFrame:
    reg = seeds.registry(spark, sf)
    return reg.withColumn(
        "policy_slug", F.concat(F.lit("pol-"), (F.col("ord") % 30).cast("string"))
    )


@query("g23_pdfs_by_slug", f"SELECT DISTINCT policy_slug, filename FROM ({_REG2})")
def _(spark, sf):
    return G.pdfs_by_slug(_registry2(spark, sf))


@query(
    "g24_policy_coverage_report",
    "SELECT title, slug, linked, file, '| ' || title || ' | `' || slug || '` | ' || linked || ' | ' || file || ' |' AS line FROM ("
    "SELECT coalesce(p.title, p.slug) AS title, p.slug, CASE WHEN len(pdf_downloads) > 0 THEN 'yes' ELSE 'no' END AS linked, "
    "CASE WHEN len(pdf_downloads) > 0 THEN coalesce(f.filename, '(unresolved)') ELSE '—' END AS file "
    f"FROM ({POLICY_PDF_SQL}) p LEFT JOIN (SELECT DISTINCT 'doc-' || ord % 60 AS policy_slug, filename FROM ({REGISTRY_SQL})) f "
    "ON f.policy_slug = p.slug AND len(pdf_downloads) > 0)",
)
def _(spark, sf):
    reg = seeds.registry(spark, sf).withColumn(
        "policy_slug", F.concat(F.lit("doc-"), (F.col("ord") % 60).cast("string"))
    )
    return G.policy_coverage_report(seeds.policy_pdfs(spark, sf), reg)


@query(
    "g24_policy_coverage_summary",
    f"SELECT count(*) AS pages, count(*) FILTER (len(pdf_downloads) > 0) AS with_pdfs FROM ({POLICY_PDF_SQL})",
)
def _(spark, sf):
    return G.policy_coverage_summary(seeds.policy_pdfs(spark, sf))


@query(
    "g25_governance_report",
    "SELECT DISTINCT CASE WHEN contains(f, 'charter') THEN 'Charter' ELSE 'Constitution' END AS document, f AS filename, "
    "'| ' || CASE WHEN contains(f, 'charter') THEN 'Charter' ELSE 'Constitution' END || ' | `' || f || '` |' AS line FROM "
    "(SELECT CASE WHEN doc_id % 3 = 0 THEN 'the-charter-' ELSE 'rules-' END || source || '.pdf' AS f, doc_id FROM documents WHERE doc_id % 5 IN (1, 2))",
)
def _(spark, sf):
    n = F.col("doc_id") % 5
    reg = table(spark, sf, "documents").select(
        F.when(n == 1, "charter").when(n == 2, "constitution").otherwise("other").alias("policy_slug"),
        F.concat(
            F.when(F.col("doc_id") % 3 == 0, "the-charter-").otherwise("rules-"), "source", F.lit(".pdf")
        ).alias("filename"),
    )
    return G.governance_report(reg).distinct()


@query(
    "g27_roster_facts",
    f"WITH m AS ({MEMBER_SQL}), l AS (SELECT * FROM m WHERE role = 'Party Leader' ORDER BY (electorate = ''), c_custkey LIMIT 1), "
    "d AS (SELECT * FROM m WHERE role = 'Deputy Leader' ORDER BY c_custkey LIMIT 1) SELECT (SELECT count(*) FROM m) AS total, "
    "(SELECT count(DISTINCT nullif(electorate, '')) FROM m) AS electorates, (SELECT name FROM l) AS leader, (SELECT electorate FROM l) AS leader_electorate, "
    "(SELECT name FROM d) AS deputy, (SELECT electorate FROM d) AS deputy_electorate",
)
def _(spark, sf):
    return G.roster_facts(seeds.members(spark, sf), "c_custkey")


def _roster_sql(where: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS part, lower(name) AS sort_name, '| [' || name || '](' || slug || '.md) | ' || role || ' | ' || "
        f"CASE WHEN electorate = '' THEN '—' ELSE electorate END || ' | [example.org](' || url || ') |' AS line FROM ({MEMBER_SQL}) {where}"
    )


@query(
    "g28_roster_tables",
    _roster_sql("WHERE role <> 'Candidate'", "leadership") + " UNION ALL " + _roster_sql("", "all"),
)
def _(spark, sf):
    m = seeds.members(spark, sf)
    lead = G.roster_table(m, "example.org", leadership_only=True)
    return lead.withColumn("part", F.lit("leadership")).unionByName(
        G.roster_table(m, "example.org").withColumn("part", F.lit("all"))
    )


@query("g29_group_by_year", f"SELECT {_YEAR} AS year, id FROM ({S16_SQL})")
def _(spark, sf):
    return R.group_by_year(R.enumerate_media(media(spark, sf))).select("year", "id")


@query(
    "g30_year_summary",
    f"SELECT {_YEAR} AS year, count(*) AS items, string_agg(DISTINCT tab, ', ' ORDER BY tab) AS tabs FROM ({S16_SQL}) GROUP BY 1 UNION ALL "
    f"SELECT 'Total', count(*), string_agg(DISTINCT tab, ', ' ORDER BY tab) FROM ({S16_SQL})",
)
def _(spark, sf):
    return G.year_summary(R.enumerate_media(media(spark, sf)))


_TYPED_SQL = (
    "SELECT CASE event_type WHEN 'view' THEN 'policy' WHEN 'click' THEN 'event' WHEN 'error' THEN 'blog-post' "
    "WHEN 'signup' THEN 'team-member' ELSE 'pdf-document' END AS content_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS cleaned_at FROM events"
)


@query(
    "g33_dataset_status",
    f"WITH t AS ({_TYPED_SQL}) SELECT content_type, count(*) AS items, max(cleaned_at) AS last_cleaned_at, "
    "CASE WHEN max(cleaned_at)::timestamp >= TIMESTAMP '" + AS_OF + "' - INTERVAL " + str(rules.FRESH_DAYS) + " DAY THEN 'fresh' ELSE 'stale' END AS freshness "
    "FROM (SELECT content_type, cleaned_at FROM t UNION ALL SELECT 'TOTAL', cleaned_at FROM t) GROUP BY content_type",
)
def _(spark, sf):
    k = F.col("event_type")
    kind = (
        F.when(k == "view", "policy").when(k == "click", "event").when(k == "error", "blog-post")
        .when(k == "signup", "team-member").otherwise("pdf-document")
    )
    rows = table(spark, sf, "events").select(
        kind.alias("content_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("cleaned_at"),
    )
    return G.dataset_status(rows, AS_OF)


@query(
    "g34_section_map",
    "SELECT 'blog' AS section, (SELECT count(*) FROM documents) AS items, '- [Post ' || doc_id || '](/blog/post-' || doc_id || '.md)' AS line FROM documents UNION ALL "
    f"SELECT 'team', (SELECT count(*) FROM customer), '- [' || name || '](/team/' || slug || '.md)' FROM ({MEMBER_SQL})",
)
def _(spark, sf):
    blog = seeds.blog_md(spark, sf).select(
        F.concat(F.lit("Post "), F.col("doc_id").cast("string")).alias("title"), "slug"
    )
    team = seeds.members(spark, sf).select(F.col("name").alias("title"), "slug")
    return G.section_map({"blog": blog, "team": team})


# --- order, listings, pages -------------------------------------------------

_BLOG_DATE = "'2026-01-' || lpad((doc_id % 28 + 1)::varchar, 2, '0')"


@query(
    "t01_home_topk",
    f"(SELECT 'posts' AS block, slug FROM ({BLOG_SQL}) ORDER BY {_BLOG_DATE} DESC, slug LIMIT 5) UNION ALL "
    f"(SELECT 'events', slug FROM ({EVENT_SQL}) ORDER BY date, slug LIMIT 5) UNION ALL "
    f"(SELECT 'team', slug FROM ({MEMBER_SQL}) ORDER BY role, slug LIMIT 8)",
)
def _(spark, sf):
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    posts = seeds.blog_md(spark, sf).withColumn("date", F.concat(F.lit("2026-01-"), day))
    return FD.home_topk(posts, seeds.event_md(spark, sf), seeds.members(spark, sf))


def _ranked(sql: str, order: str, name: str) -> str:
    return f"SELECT '{name}' AS collection, slug, row_number() OVER (ORDER BY {order}) AS n FROM ({sql})"


@query(
    "t02_collection_orders",
    " UNION ALL ".join((
        _ranked(MEMBER_SQL, "name, slug", "team"), _ranked(MEMBER_SQL, "role, name, slug", "team-cards"),
        _ranked(EVENT_SQL, "date, slug", "events"),
        _ranked(f"SELECT slug, {_BLOG_DATE} AS date FROM ({BLOG_SQL})", "date DESC, slug", "blog"),
        _ranked("SELECT 'p' || doc_id AS slug, 'title ' || lpad((doc_id % 90)::varchar, 2, '0') AS title FROM documents",
                "title, slug", "policies"),
    )),
)
def _(spark, sf):
    """Every published order as a rank, so that the order itself is compared."""
    team = seeds.members(spark, sf)
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    posts = seeds.blog_md(spark, sf).withColumn("date", F.concat(F.lit("2026-01-"), day))
    policies = table(spark, sf, "documents").select(
        F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("slug"),
        F.concat(F.lit("title "), F.lpad((F.col("doc_id") % 90).cast("string"), 2, "0")).alias("title"),
    )
    out = None
    for name, df in (("team", team), ("team-cards", team), ("events", seeds.event_md(spark, sf)),
                     ("blog", posts), ("policies", policies)):
        rows = numbered(df.select(*[c for c in ("slug", "title", "date", "name", "role") if c in df.columns]),
                        [], G.collection_order(name)).select(F.lit(name).alias("collection"), "slug", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "t03_collection_listing",
    f"SELECT slug, '## [Post ' || doc_id || '](/blog/' || slug || '.md)' || chr(10) || chr(10) || 'By ' || source || chr(10) || {d_summary('text', 100)} || chr(10) AS entry "
    f"FROM ({BLOG_SQL}) UNION ALL SELECT slug, '## [Post ' || doc_id || '](/policies/' || slug || '.md)' || chr(10) || chr(10) || {d_summary('text', 200)} || chr(10) FROM ({BLOG_SQL}) UNION ALL "
    f"SELECT slug, '## [' || name || '](/team/' || slug || ')' || chr(10) || chr(10) || '**Role:** ' || role || chr(10) || CASE WHEN electorate = '' THEN '' ELSE '**Electorate:** ' || electorate END || chr(10) FROM ({MEMBER_SQL})",
)
def _(spark, sf):
    docs = seeds.blog_md(spark, sf).select(
        "slug", F.concat(F.lit("Post "), F.col("doc_id").cast("string")).alias("title"),
        F.col("source").alias("author"), F.col("text").alias("body"),
    )
    return (
        G.collection_listing(docs, "blog")
        .unionByName(G.collection_listing(docs, "policies"))
        .unionByName(G.collection_listing(seeds.members(spark, sf), "team"))
    )


@query(
    "t03_event_listing",
    f"SELECT slug, '## [Event ' || event_id || '](/events/' || slug || ')' || chr(10) || chr(10) || '**When:** ' || strftime(ts, '%H:%M') || chr(10) || '**Venue:** ' || event_type || ' hall' || chr(10) || "
    "'**Address:** ' || user_id || ' Queen Street' || chr(10) AS entry, CASE WHEN event_id % 2 = 0 THEN 'TBD' ELSE strftime(ts, '%Y-%m-%d') END || ' — Event ' || event_id || ' · City ' || user_id % 50 AS line "
    f"FROM (SELECT *, 'event-' || event_id AS slug FROM events)",
)
def _(spark, sf):
    from corpusloom.operators.normalise import clean_events

    ev = clean_events(seeds.event_md(spark, sf), CLEANED_AT)
    even = F.regexp_extract("slug", r"(\d+)", 1).cast("bigint") % 2 == 0
    dated = ev.withColumn("date", F.when(even, "").otherwise(F.col("date"))).withColumn("line", G.event_list_line())
    return G.collection_listing(dated, "events", "line")


@query(
    "t04_paginate",
    "SELECT event_id, (SELECT count(*) FROM events) AS total FROM events ORDER BY value DESC, event_id LIMIT 7 OFFSET 13",
)
def _(spark, sf):
    ev = table(spark, sf, "events")
    page = FD.paginate(ev, [down("value"), up("event_id")], 7, 13)
    return page.items.select("event_id", page.envelope.select("total").scalar().alias("total"))


@query(
    "t04_deep_page",
    "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS n FROM events) "
    "WHERE n > (SELECT count(*) // 2 FROM events) AND n <= (SELECT count(*) // 2 FROM events) + 10",
)
def _(spark, sf):
    """A page from the middle of the order, found by counts; few rows are left to be sorted."""
    ev = table(spark, sf, "events").select("event_id", "value")
    return nth_rows(ev, [down("value"), up("event_id")], ev.count() // 2, 10, small=500).select("event_id")


@query(
    "t04_envelope",
    "SELECT count(*) AS total, 7::bigint AS count, 13::bigint AS \"offset\", true AS has_more, 20::bigint AS next_offset FROM events",
)
def _(spark, sf):
    ev = table(spark, sf, "events")
    return FD.paginate(ev, [down("value"), up("event_id")], 7, 13).envelope


@query(
    "t05_item_page",
    "SELECT doc_id, '# Post' || chr(10) || chr(10) || CASE WHEN lang = 'en' THEN '' ELSE '**Date:** ' || lang END || chr(10) || '**Author:** ' || source || chr(10) || chr(10) || text AS page FROM documents",
)
def _(spark, sf):
    from corpusloom.functions.markdown import item_page

    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", item_page(F.lit("Post"), lang, F.col("source"), F.col("text")).alias("page")
    )


# --- faceted queries --------------------------------------------------------

_EV = f"SELECT * FROM ({R03_SQL})"


@query(
    "f01_find_events",
    f"SELECT slug, title, date, time, location, venue, address FROM ({_EV}) WHERE date >= '2024-01-10' AND date <= '2024-01-20' AND date >= '2024-01-12' "
    "AND (contains(lower(location), 'city 1') OR contains(lower(address), 'city 1')) AND contains(lower(venue), 'view') "
    "AND (contains(lower(title), 'props') OR contains(lower(body), 'props')) ORDER BY date, slug LIMIT 30",
)
def _(spark, sf):
    page = FD.find_events(
        _event_items(spark, sf), "2024-01-12", query="PROPS ", date_from="2024-01-10", date_to="2024-01-20",
        location="CITY 1", venue="View", limit=30,
    )
    return page.items.drop("content_type", "registration_url", "source_url")


def _event_items(spark: SparkSession, sf: str) -> DataFrame:
    from corpusloom.operators.normalise import clean_events

    return stored(spark, clean_events(seeds.event_md(spark, sf), CLEANED_AT))


def _indexed_events(spark: SparkSession, sf: str):
    from corpusloom.operators.normalise import clean_events

    return indexed_store(spark, clean_events(seeds.event_md(spark, sf), CLEANED_AT))


@query(
    "f01_indexed_events",
    f"SELECT slug, title, date, time, venue FROM ({_EV}) WHERE date >= '2024-01-12' "
    "AND (contains(lower(title), 'props') OR contains(lower(body), 'props')) ORDER BY date, slug LIMIT 50",
)
def _(spark, sf):
    page = FD.find_events(_indexed_events(spark, sf), "2024-01-12", query="Props", limit=50)
    return page.items.select("slug", "title", "date", "time", "venue")


@query("f01_find_events_envelope",
       f"SELECT count(*) AS total, least(20, count(*)) AS count, 0::bigint AS \"offset\", count(*) > 20 AS has_more, "
       f"CASE WHEN count(*) > 20 THEN 20 END::bigint AS next_offset FROM ({_EV}) WHERE date >= '2024-01-25'")
def _(spark, sf):
    return FD.find_events(_event_items(spark, sf), "2024-01-25").envelope


@query(
    "f01_matching_past_events",
    "SELECT 'event-' || event_id AS slug FROM events WHERE event_id % 9 = 0 OR strftime(ts, '%Y-%m-%d') <= '2024-01-05'",
)
def _(spark, sf):
    ninth = F.regexp_extract("slug", r"(\d+)", 1).cast("bigint") % 9 == 0
    ev = _event_items(spark, sf).withColumn("date", F.when(ninth, "soon").otherwise(F.col("date")))
    return FD.matching_events(ev, AS_OF[:10], include_past=True, date_to="2024-01-05").select("slug")


def _team_items(spark: SparkSession, sf: str) -> DataFrame:
    from corpusloom.operators.normalise import clean_team

    return stored(spark, clean_team(seeds.member_md(spark, sf), CLEANED_AT))


@query(
    "f02_find_members",
    f"SELECT slug, name AS title, name, role, electorate FROM ({MEMBER_SQL}) WHERE lower(role) = 'candidate' AND lower(electorate) = 'nation 3' ORDER BY role, name, slug LIMIT 20 OFFSET 2",
)
def _(spark, sf):
    page = FD.find_members(
        _team_items(spark, sf), role="CANDIDATE", electorate=" Nation 3 ", query="customer", limit=20, offset=2
    )
    return page.items.drop("content_type", "source_url")


@query(
    "f02_indexed_members",
    f"SELECT slug, name, role, electorate FROM ({MEMBER_SQL}) WHERE contains(lower(name), 'mer 00000001') ORDER BY role, name, slug LIMIT 50",
)
def _(spark, sf):
    from corpusloom.operators.normalise import clean_team

    store = indexed_store(spark, clean_team(seeds.member_md(spark, sf), CLEANED_AT))
    return FD.find_members(store, query="MER 00000001").items.select("slug", "name", "role", "electorate")


# Documents as policies tagged with language and source; labelled ones own one
# pdf per remainder of their number, so lists differ in length.
_POL_SQL = (
    "SELECT doc_id, 'doc-' || doc_id AS slug, 'Title ' || doc_id % 100 AS title, lang, source, text FROM documents"
)
_POLPDF_SQL = "SELECT doc_id, unnest(range(doc_id % 4 + 1)) AS k FROM labels"


def _policy_items(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    slug = F.concat(F.lit("doc-"), key)
    pol = table(spark, sf, "documents").select(
        slug.alias("slug"), F.lit("policy").alias("content_type"), F.lit("u").alias("source_url"),
        F.concat(F.lit("Title "), (F.col("doc_id") % 100).cast("string")).alias("title"),
        F.lit("").alias("summary"), F.array(F.upper("lang"), "source").alias("tags"),
        F.col("text").alias("body"),
    )
    pdf = table(spark, sf, "labels").select(
        "doc_id", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int"))).alias("k")
    ).select(
        F.concat(slug, F.lit("-f"), F.col("k").cast("string")).alias("slug"),
        F.lit("pdf-document").alias("content_type"), slug.alias("policy_slug"),
        F.lit("").alias("body"),
    )
    return schemas.conform(pol).unionByName(schemas.conform(pdf))


_SLUGS = (
    "coalesce((SELECT string_agg('doc-' || l.doc_id || '-f' || k, ',' ORDER BY k) FROM "
    f"({_POLPDF_SQL}) l WHERE l.doc_id = p.doc_id), '')"
)


@query(
    "f03_find_policies",
    f"SELECT slug, title, lower(lang) || ',' || source AS tags, {_SLUGS} AS pdf_slugs FROM (SELECT * FROM ({_POL_SQL}) WHERE lang = 'en' AND "
    "(contains(lower(title) || ' ' || lower(text), 'th q') OR doc_id % 7 = 0) AND doc_id IN (SELECT doc_id FROM labels) ORDER BY title, slug LIMIT 25) p",
)
def _(spark, sf):
    sections = table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("slug"),
        F.explode(F.array(F.lit("none"), F.when(F.col("doc_id") % 7 == 0, "With Quotes"))).alias("detail"),
    )
    page = FD.find_policies(
        _policy_items(spark, sf), sections, query="TH Q", tags=["en"], has_pdf=True, limit=25)
    return page.items.select(
        "slug", "title", F.lower(F.array_join("tags", ",")).alias("tags"),
        F.array_join("pdf_slugs", ",").alias("pdf_slugs"),
    )


@query(
    "f03_indexed_policies",
    f"SELECT slug, title, lower(lang) || ',' || source AS tags, {_SLUGS} AS pdf_slugs FROM (SELECT * FROM ({_POL_SQL}) WHERE "
    "contains(lower(title), 'th q') OR contains(lower(text), 'th q') OR doc_id % 7 = 0 ORDER BY title, slug LIMIT 100) p",
)
def _(spark, sf):
    """The same search through the index of a store, which names candidates by their own texts and by their sections."""
    sections = table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("slug"), F.lit("a.pdf").alias("file"),
        F.lit("").alias("heading"), F.when(F.col("doc_id") % 7 == 0, "With Quotes").otherwise("none").alias("detail"),
    )
    page = FD.find_policies(indexed_store(spark, _policy_items(spark, sf), sections), query="TH Q", limit=100)
    return page.items.select(
        "slug", "title", F.lower(F.array_join("tags", ",")).alias("tags"),
        F.array_join("pdf_slugs", ",").alias("pdf_slugs"),
    )


@query(
    "j11_policy_pdf_slugs",
    f"SELECT slug, CASE WHEN k IS NOT NULL THEN slug || '-f' || k END AS pdf_slug FROM ({_POL_SQL}) p LEFT JOIN ({_POLPDF_SQL}) USING (doc_id)",
)
def _(spark, sf):
    rows = _policy_items(spark, sf)
    return FD.policy_pdf_slugs(rows.filter("content_type = 'policy'"), FD.linked_pdfs(rows))


@query("j12_has_pdf", "SELECT 'doc-' || doc_id AS slug, doc_id IN (SELECT doc_id FROM labels) AS has_pdf FROM documents")
def _(spark, sf):
    rows = _policy_items(spark, sf)
    pol, pdfs = rows.filter("content_type = 'policy'"), FD.linked_pdfs(rows)
    return FD.has_pdf(pol, pdfs, True).select("slug", F.lit(True).alias("has_pdf")).unionByName(
        FD.has_pdf(pol, pdfs, False).select("slug", F.lit(False).alias("has_pdf"))
    )


def _blog_items(spark: SparkSession, sf: str) -> DataFrame:
    from corpusloom.operators.normalise import clean_blog_posts

    return stored(spark, clean_blog_posts(seeds.blog_md(spark, sf), CLEANED_AT))


@query(
    "f04_indexed_posts",
    f"SELECT slug, title, date, author FROM ({R02_SQL}) WHERE contains(lower(title), 'tion') OR contains(lower(body), 'tion') "
    "ORDER BY date DESC, slug LIMIT 60",
)
def _(spark, sf):
    from corpusloom.operators.normalise import clean_blog_posts

    store = indexed_store(spark, clean_blog_posts(seeds.blog_md(spark, sf), CLEANED_AT))
    return FD.find_blog_posts(store, query="TION", limit=60).items.select("slug", "title", "date", "author")


@query(
    "f04_find_blog_posts",
    f"SELECT slug, title, date, author FROM ({R02_SQL}) WHERE date >= '2026-01-05' AND date <= '2026-01-12' AND "
    "(contains(lower(title), 'en') OR contains(lower(body), 'en')) ORDER BY date DESC, slug LIMIT 40",
)
def _(spark, sf):
    page = FD.find_blog_posts(
        _blog_items(spark, sf), query="EN", date_from="2026-01-05", date_to="2026-01-12", limit=40
    )
    return page.items.select("slug", "title", "date", "author")


@query("f05_get_item", f"SELECT slug, title, body FROM ({R02_SQL}) WHERE slug = 'post-17'")
def _(spark, sf):
    return FD.get_item(_blog_items(spark, sf), "blog-post", "post-17").select("slug", "title", "body")


@query(
    "f06_lookup_errors",
    "SELECT content_type, slug, CASE WHEN content_type = 'blog-post' AND e % 3 <> 0 AND s < (SELECT count(*) FROM documents) THEN 'Post ' || s END AS title, CASE WHEN content_type = 'video' THEN 'invalid_content_type' "
    "WHEN s >= (SELECT count(*) FROM documents) THEN 'not_found' END AS error FROM (SELECT event_id AS e, event_id % 1500 AS s, CASE WHEN event_id % 3 = 0 THEN 'video' ELSE 'blog-post' END AS content_type, "
    "'post-' || event_id % 1500 AS slug FROM events)",
)
def _(spark, sf):
    requests = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 3 == 0, "video").otherwise("blog-post").alias("content_type"),
        F.concat(F.lit("post-"), (F.col("event_id") % 1500).cast("string")).alias("slug"),
    )
    return FD.lookup_items(requests, _blog_items(spark, sf))


@query(
    "f07_check_arguments",
    "SELECT event_id, CASE WHEN event_id % 11 = 0 OR (event_id % 11 = 1 AND length(props) * 20 > 200) THEN 'query must have 1 to 200 characters' "
    "WHEN event_id % 5 = 0 THEN 'date_from must be a date' WHEN user_id % 120 NOT BETWEEN 1 AND 100 THEN 'limit must be between 1 and 100' "
    "WHEN event_id % 7 = 0 THEN 'offset must not be negative' END AS error FROM events",
)
def _(spark, sf):
    """Requests as a log keeps them, with every kind of bad argument."""
    n = F.col("event_id")
    text = F.when(n % 11 == 0, "  ").when(n % 11 == 1, F.repeat("props", F.lit(20))).otherwise(F.col("event_type"))
    requests = table(spark, sf, "events").select(
        "event_id", text.alias("query"), (F.col("user_id") % 120).alias("limit"),
        F.when(n % 7 == 0, -1).otherwise(n).alias("offset"),
        F.when(n % 5 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date_from"),
    )
    return FD.argument_errors(requests).select("event_id", "error")
