"""Queries over records and items: normalise, merge, registry, snapshots, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import rules, schemas
from corpusloom.functions import markdown as M
from corpusloom.functions.text import strip
from corpusloom.operators import normalise as N
from corpusloom.operators import registry as R
from corpusloom.operators import snapshots as S
from corpusloom.plans import seeds
from corpusloom.plans.book import (
    WS_LIT,
    d_collapse,
    d_strip,
    d_title,
    lit,
    query,
    table,
)
from corpusloom.plans.seeds import (
    AS_OF,
    BLOG_SQL,
    CLEANED_AT,
    EVENT_SQL,
    MEMBER_MD_SQL,
    NEWS_SQL,
    PDF_BODY_SQL,
    PDF_FILE_SQL,
    POLICY_PDF_SQL,
    POLICY_SQL,
    REGISTRY_SQL,
    SNAPSHOT_SQL,
)
from corpusloom.plans.text_queries import d_clean, d_field, d_h1, d_no_fields, d_quote_field
from corpusloom.session import checkpoint_folder
from corpusloom.sources import readers, writers
from corpusloom.sources import registry as source_registry
from corpusloom.sources.files import write_item_folders
from corpusloom.sources.snapshot_log import SnapshotLog
from corpusloom.streaming.incremental import (
    first_seen_ever,
    first_seen_stream,
    incremental_clean,
    read_first_seen,
)


def _prov(kind: str, url: str, ingested: str) -> str:
    return (
        f"slug, '{kind}' AS content_type, '{rules.SOURCE_ID}' AS source_id, '{rules.SOURCE_TYPE}' AS source_type, "
        f"{url} AS source_url, {ingested} AS ingested_at, '{CLEANED_AT}' AS cleaned_at"
    )


# --- typed projections ------------------------------------------------------

# Pages as policies, which own the PDF files of the policy of the same number.
_PDF_SLUGS = f"SELECT DISTINCT replace(policy_slug, 'pol-', 'page-') AS slug FROM ({PDF_FILE_SQL})"
R01_SQL = (
    f"SELECT {_prov('policy', 'url', lit('2026-01-01T00:00:00'))}, trim(title) AS title, "
    f"{d_clean('raw', 'title')} AS body FROM ({POLICY_SQL}) UNION ALL "
    f"SELECT {_prov('policy', lit(''), lit(''))}, {d_title('replace(slug, chr(45), chr(32))')}, '' "
    f"FROM ({_PDF_SLUGS}) WHERE slug NOT IN (SELECT 'page-' || page_id FROM pages)"
)


def _page_pdfs(spark: SparkSession, sf: str) -> DataFrame:
    return seeds.pdf_files(spark, sf).withColumn(
        "policy_slug", F.replace("policy_slug", F.lit("pol-"), F.lit("page-"))
    )


def policies(spark: SparkSession, sf: str) -> DataFrame:
    raw = seeds.policy_md(spark, sf).select("slug", "raw")
    index = table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("slug"),
        F.lit("").alias("title"),
        F.concat(F.lit("https://idx.example.org/"), F.col("page_id").cast("string")).alias("url"),
        F.lit("").alias("scraped_at"),
        F.array().cast("array<string>").alias("pdf_downloads"),
        F.col("page_id").alias("ord"),
    )
    return N.clean_policies(raw, index, _page_pdfs(spark, sf), CLEANED_AT)


@query("r01_clean_policies", R01_SQL)
def _(spark, sf):
    return policies(spark, sf).drop("summary", "pdf_urls", "tags")


R02_SQL = (
    f"SELECT {_prov('blog-post', d_field('raw', 'URL'), d_field('raw', 'Scraped'))}, "
    f"{d_field('raw', 'Title')} AS title, {d_field('raw', 'Date')} AS date, {d_field('raw', 'Author')} AS author, "
    f"'' AS excerpt, {d_clean(d_no_fields('raw'), d_field('raw', 'Title'), footer=False)} AS body "
    f"FROM ({BLOG_SQL})"
)


@query("r02_clean_blog_posts", R02_SQL)
def _(spark, sf):
    return N.clean_blog_posts(seeds.blog_md(spark, sf), CLEANED_AT)


R03_SQL = (
    f"SELECT {_prov('event', d_field('raw', 'URL'), lit(''))}, {d_field('raw', 'Title')} AS title, "
    f"{d_field('raw', 'Date')} AS date, {d_field('raw', 'When')} AS time, {d_field('raw', 'Location')} AS location, "
    f"{d_field('raw', 'Venue')} AS venue, {d_field('raw', 'Address')} AS address, '' AS description, "
    "'' AS registration_url, "
    f"{d_clean(d_no_fields('raw'), d_field('raw', 'Title'), False, False)} AS body FROM ({EVENT_SQL})"
)


@query("r03_clean_events", R03_SQL)
def _(spark, sf):
    return N.clean_events(seeds.event_md(spark, sf), CLEANED_AT)


R04_SQL = (
    f"SELECT {_prov('team-member', 'url', lit('2026-01-01T00:00:00'))}, name, role, electorate, "
    f"{d_clean(d_no_fields('raw'), 'name', footer=False)} AS body FROM ({MEMBER_MD_SQL})"
)


@query("r04_clean_team", R04_SQL)
def _(spark, sf):
    return N.clean_team(seeds.member_md(spark, sf), CLEANED_AT)


R05_SQL = (
    f"SELECT {_prov('party-information', 'url', lit('2026-01-01T00:00:00'))}, trim(title) AS title, "
    f"{d_clean('raw', 'title', contact=False)} AS body FROM ({POLICY_SQL})"
)


@query("r05_clean_party_info", R05_SQL)
def _(spark, sf):
    return N.clean_party_info(seeds.policy_md(spark, sf).select("slug", "raw"), CLEANED_AT)


R06_SQL = (
    f"SELECT {_prov('blog-post', d_quote_field('raw', 'URL'), d_quote_field('raw', 'Scraped'))}, "
    f"{d_h1('raw')} AS title, '' AS date, '' AS author, '' AS excerpt, "
    f"{d_clean('raw', d_h1('raw'), footer=False)} AS body FROM ({NEWS_SQL})"
)


@query("r06_clean_news", R06_SQL)
def _(spark, sf):
    return N.clean_news(seeds.news_md(spark, sf).select("slug", "raw"), CLEANED_AT)


def _r07(where: str) -> str:
    return (
        "SELECT policy_slug || '-part-' || doc_id % 8 AS slug, 'pdf-document' AS content_type, "
        f"'{rules.SOURCE_ID}' AS source_id, '{rules.SOURCE_TYPE}' AS source_type, '' AS source_url, "
        f"'{CLEANED_AT}' AS ingested_at, '{CLEANED_AT}' AS cleaned_at, source || ' — ' || lang || ' paper' AS title, "
        f"policy_slug, {PDF_BODY_SQL} AS body FROM ({PDF_FILE_SQL}) JOIN "
        f"(SELECT doc_id, source, lang FROM documents) USING (doc_id) {where}"
    )


@query("r07_clean_pdf_documents", _r07(""))
def _(spark, sf):
    return N.clean_pdf_documents(seeds.pdf_files(spark, sf), CLEANED_AT)


@query("r07_one_policy", _r07("WHERE policy_slug = 'pol-3'"))
def _(spark, sf):
    return N.clean_pdf_documents(seeds.pdf_files(spark, sf), CLEANED_AT, "pol-3")


_SITE_BLOG = (
    "concat_ws(chr(10), '---', 'title: \"Post ' || doc_id || '\"', 'slug: ' || slug, 'date: \"' || "
    + d_field("raw", "Date") + " || '\"', 'author: \"' || source || '\"', "
    "'url: \"https://www.example.org/blog/' || doc_id || '\"', 'scrapedAt: \"2026-01-02T00:00:00\"', '---') || chr(10) || "
    "ltrim(" + d_clean(d_no_fields("raw"), d_field("raw", "Title"), footer=False) + ", chr(10))"
)
_SITE_TEAM = (
    "concat_ws(chr(10), '---', 'name: \"' || name || '\"', 'slug: ' || slug, 'role: \"' || role || '\"', "
    "CASE WHEN electorate <> '' THEN 'electorate: \"' || electorate || '\"' END, 'url: \"' || url || '\"', "
    "'scrapedAt: \"2026-01-01T00:00:00\"', '---') || chr(10) || ltrim("
    + d_clean(d_no_fields("raw"), "name", footer=False) + ", chr(10))"
)


def _site_sql(sql: str, collection: str, fields: dict[str, str]) -> str:
    """Published pages over a typed query: frontmatter lines of the fields that are not empty, then the body."""
    rows = "".join(f", CASE WHEN {c} <> '' THEN '{k}: \"' || replace({c}, '\"', '\\\"') || '\"' END" for k, c in fields.items())
    plain = "slug" if collection == "events" else d_title("replace(slug, chr(45), chr(32))")
    title = f"coalesce(nullif(title, ''), {plain})"
    page = (
        f"concat_ws(chr(10), '---', 'title: \"' || replace({title}, '\"', '\\\"') || '\"', 'slug: ' || slug" + rows
        + ", '---') || chr(10) || ltrim(body, chr(10))"
    )
    return f"SELECT slug, '{collection}' AS collection, {d_collapse(page)} AS md FROM ({sql})"


@query(
    "r08_site_tables",
    f"SELECT slug, 'blog' AS collection, {d_collapse(_SITE_BLOG)} AS md FROM ({BLOG_SQL}) UNION ALL "
    f"SELECT slug, 'team', {d_collapse(_SITE_TEAM)} FROM ({MEMBER_MD_SQL}) UNION ALL "
    + _site_sql(R01_SQL, "policies", {k: c for k, c in M.SITE_FIELDS["policies"]}) + " UNION ALL "
    + _site_sql(R03_SQL, "events", {k: c for k, c in M.SITE_FIELDS["events"]}) + " UNION ALL "
    + _site_sql(R05_SQL, "party-info", {k: c for k, c in M.SITE_FIELDS["party-info"]}),
)
def _(spark, sf):
    rows = items(spark, sf).filter("content_type <> 'blog-post' or date <> ''")
    out = None
    for c in N.COLLECTIONS:
        pages = N.site_table(rows, c).select("slug", F.lit(c).alias("collection"), "md")
        out = pages if out is None else out.unionByName(pages)
    return out


@query(
    "r09_valid_collection_rows",
    f"SELECT slug, title IS NOT NULL AS valid FROM ({POLICY_PDF_SQL})",
)
def _(spark, sf):
    good, bad = N.split_valid(seeds.policy_pdfs(spark, sf), "policies")
    return good.select("slug", F.lit(True).alias("valid")).unionByName(
        bad.select("slug", F.lit(False).alias("valid"))
    )


def media(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Events as two tabs of a media channel; an id can be listed in both."""
    ev = table(spark, sf, "events")
    rows = ev.select(
        F.concat(F.lit("v"), (F.col("event_id") % 700).cast("string")).alias("id"),
        F.col("event_id").alias("ord"),
        F.when(F.col("event_id") % 37 == 0, "").otherwise(
            F.concat((F.lit(2020) + F.col("user_id") % 5).cast("string"), F.date_format("ts", "MMdd"))
        ).alias("upload_date"),
        F.col("event_type").alias("title"),
    )
    short = F.col("ord") % 3 == 0
    return {"videos": rows.filter(~short), "shorts": rows.filter(short)}


MEDIA_SQL = (
    "SELECT 'v' || event_id % 700 AS id, event_id AS ord, CASE WHEN event_id % 37 = 0 THEN '' ELSE "
    "(2020 + user_id % 5) || strftime(ts, '%m%d') END AS upload_date, event_type AS title, "
    "CASE WHEN event_id % 3 = 0 THEN 'shorts' ELSE 'videos' END AS tab, event_id % 3 = 0 AS late FROM events"
)
S16_SQL = (
    "SELECT id, ord, upload_date, title, tab FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY late, ord) AS rn "
    f"FROM ({MEDIA_SQL})) WHERE rn = 1"
)
_YEAR = "CASE WHEN length(upload_date) >= 4 THEN left(upload_date, 4) ELSE 'unknown' END"


@query("s16_enumerate_media", S16_SQL)
def _(spark, sf):
    return R.enumerate_media(media(spark, sf))


@query("g31_dedupe_by_id",
       "SELECT user_id, min(event_id) AS event_id, min_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return R.dedupe_by_id(ev, "user_id", F.col("event_id"))


@query("r09b_year_filter", f"SELECT id, upload_date FROM ({S16_SQL}) WHERE {_YEAR} = '2022'")
def _(spark, sf):
    items = R.group_by_year(R.enumerate_media(media(spark, sf)))
    return items.filter(F.col("year") == "2022").select("id", "upload_date")


@query("r09c_category_select",
       "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def _(spark, sf):
    known = ["click", "view", "error", "signup", "purchase"]
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return N.category_select(ev, "event_type", ["click", "view"], known)


# --- joins ------------------------------------------------------------------


@query(
    "j01_policy_with_index",
    "SELECT d.doc_id, 't1-' || quality AS idx_title FROM documents d LEFT JOIN labels USING (doc_id)",
)
def _(spark, sf):
    # every labelled document has two index entries, of which the later counts
    index = table(spark, sf, "labels").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("slug"), "quality",
        F.explode(F.array(F.lit(1), F.lit(0))).alias("ord"),
    ).select(
        "slug",
        F.concat(F.lit("t"), F.col("ord").cast("string"), F.lit("-"), F.col("quality").cast("string")).alias("title"),
        F.lit("").alias("url"), F.lit("").alias("scraped_at"),
        F.array().cast("array<string>").alias("pdf_downloads"), "ord",
    )
    raw = seeds.policy_pdfs(spark, sf).select("doc_id", "slug")
    return N.policy_with_index(raw, index).select("doc_id", "idx_title")


@query(
    "j02_pdf_only_policies",
    "SELECT DISTINCT 'doc-' || doc_id * 2 AS slug FROM documents WHERE doc_id * 2 NOT IN (SELECT doc_id FROM documents)",
)
def _(spark, sf):
    pdfs = table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), (F.col("doc_id") * 2).cast("string")).alias("policy_slug")
    )
    return N.pdf_only_slugs(pdfs, seeds.policy_pdfs(spark, sf))


@query(
    "j03_policy_with_pdf_text",
    f"SELECT p.slug, 'Body ' || p.slug AS body, a.file, a.detail FROM (SELECT DISTINCT policy_slug AS slug FROM ({PDF_FILE_SQL})) p "
    f"LEFT JOIN (SELECT policy_slug AS slug, file, {d_strip(PDF_BODY_SQL)} AS detail "
    f"FROM ({PDF_FILE_SQL}) WHERE doc_id IN (SELECT doc_id FROM labels)) a ON a.slug = p.slug AND a.detail <> ''",
)
def _(spark, sf):
    files = seeds.pdf_files(spark, sf)
    items = files.select(F.col("policy_slug").alias("slug")).distinct().select(
        "slug", F.concat(F.lit("Body "), "slug").alias("body")
    )
    labelled = table(spark, sf, "labels").select("doc_id")
    return N.policy_with_pdf_text(items, N.pdf_sections(files.join(labelled, "doc_id", "left_semi")))


@query(
    "j04_merge_meta",
    "SELECT slug, CASE WHEN n.slug2 IS NULL THEN o.title ELSE n.title END AS title, o.html_path AS html_path, n.lang AS lang, "
    "coalesce(n.k, o.k) AS k, o.z AS z FROM (SELECT 'd' || doc_id AS slug, 'old' AS title, 'h/' || doc_id AS html_path, "
    "'o' || doc_id AS k, 'z' || doc_id AS z FROM documents) o FULL OUTER JOIN (SELECT 'd' || doc_id * 2 AS slug, 1 AS slug2, "
    "CASE WHEN doc_id % 3 <> 0 THEN 'new' END AS title, lang, 'n' || doc_id AS k FROM documents) n USING (slug)",
)
def _(spark, sf):
    """Every second old row meets a new one; a third of the new titles are null, and win."""
    docs = table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")
    old = docs.select(
        F.concat(F.lit("d"), key).alias("slug"), F.lit("old").alias("title"), F.concat(F.lit("h/"), key).alias("html_path"),
        F.create_map(F.lit("k"), F.concat(F.lit("o"), key), F.lit("z"), F.concat(F.lit("z"), key)).alias("extra"),
    )
    new = docs.select(
        F.concat(F.lit("d"), (F.col("doc_id") * 2).cast("string")).alias("slug"),
        F.when(F.col("doc_id") % 3 != 0, "new").alias("title"), "lang",
        F.create_map(F.lit("k"), F.concat(F.lit("n"), key)).alias("extra"),
    )
    return N.merge_meta(old, new, ["slug"], extra="extra").select(
        "slug", "title", "html_path", "lang",
        F.try_element_at("extra", F.lit("k")).alias("k"), F.try_element_at("extra", F.lit("z")).alias("z"),
    )


@query(
    "j05_pdf_entries_to_items",
    "SELECT doc_id, doc_id IN (SELECT doc_id * 2 FROM documents) AND doc_id IN (SELECT doc_id FROM labels) AS matched FROM documents",
)
def _(spark, sf):
    key = F.col("doc_id").cast("string")
    docs = table(spark, sf, "documents")
    index = docs.select(
        "doc_id", F.concat(F.lit("p"), key).alias("policy_slug"),
        F.concat(F.lit("f"), key, F.lit(".pdf")).alias("source_file"),
        F.concat(F.lit("/data/p"), key, F.lit("/pdf-default.md")).alias("output_file"),
    )
    items = docs.select(F.concat(F.lit("p"), (F.col("doc_id") * 2).cast("string"), F.lit("-default")).alias("slug"))
    files = table(spark, sf, "labels").select(F.concat(F.lit("f"), key, F.lit(".pdf")).alias("filename"))
    hit, miss = R.pdf_entries_to_items(index, items, files)
    return hit.select("doc_id", F.lit(True).alias("matched")).unionByName(
        miss.select("doc_id", F.lit(False).alias("matched"))
    )


@query(
    "j06_slug_from_registry",
    "SELECT d.doc_id, coalesce(r.policy_slug, 'f' || d.doc_id % 400) AS policy_slug FROM documents d LEFT JOIN "
    f"(SELECT filename, min_by(policy_slug, ord) AS policy_slug FROM ({REGISTRY_SQL}) GROUP BY filename) r "
    "ON r.filename = 'f' || d.doc_id % 400 || '.pdf'",
)
def _(spark, sf):
    files = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("f"), (F.col("doc_id") % 400).cast("string"), F.lit(".pdf")).alias("filename"),
    )
    return R.slug_from_registry(files, seeds.registry(spark, sf)).select("doc_id", "policy_slug")


_LINKS = (
    "SELECT doc_id * 10 + i AS ord, slug, url, md5, CASE WHEN url LIKE '%/file/d/%' THEN regexp_extract(url, '/file/d/([A-Za-z0-9_-]+)', 1) ELSE url END AS key, "
    "url LIKE '%/file/d/%' AS drive FROM (SELECT p.doc_id, p.slug, unnest(pdf_downloads) AS url, generate_subscripts(pdf_downloads, 1) AS i, "
    "CASE WHEN p.doc_id % 7 = 0 THEN NULL ELSE md5(text) END AS md5 "
    f"FROM ({POLICY_PDF_SQL}) p JOIN (SELECT doc_id, text FROM documents) t ON p.doc_id = t.doc_id)"
)


def _links(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 != 0, F.md5("text")).alias("md5")
    )
    rows = seeds.policy_pdfs(spark, sf).join(texts, "doc_id")
    return rows.select(
        "doc_id", F.col("slug").alias("policy_slug"), "md5", F.posexplode("pdf_downloads").alias("i", "url")
    ).select((F.col("doc_id") * 10 + F.col("i") + 1).alias("ord"), "policy_slug", "url", "md5")


@query(
    "j07_classify_downloads",
    f"WITH l AS ({_LINKS}), g AS ({REGISTRY_SQL}), a AS (SELECT l.*, r.filename AS reg_file FROM l LEFT JOIN (SELECT * FROM g WHERE present) r USING (key)), "
    "f AS (SELECT key, min(ord) AS first_ord, min_by(md5, ord) AS first_md5, min_by(CASE WHEN drive THEN key || '.pdf' ELSE list_last(string_split(url, '/')) END, ord) AS first_own "
    "FROM a WHERE reg_file IS NULL AND md5 IS NOT NULL GROUP BY key), "
    "h AS (SELECT first_md5, min(first_ord) AS hash_ord, min_by(first_own, first_ord) AS hash_own FROM f GROUP BY first_md5), "
    "m AS (SELECT md5 AS first_md5, min_by(filename, ord) AS hash_file FROM g GROUP BY md5), "
    "b AS (SELECT a.*, f.first_ord, f.first_own, coalesce(m.hash_file, CASE WHEN h.hash_ord < f.first_ord THEN h.hash_own END) AS canonical, "
    "CASE WHEN drive THEN a.key || '.pdf' ELSE list_last(string_split(url, '/')) END AS own FROM a LEFT JOIN f USING (key) "
    "LEFT JOIN h ON h.first_md5 = f.first_md5 LEFT JOIN m ON m.first_md5 = f.first_md5) "
    "SELECT ord, slug AS policy_slug, url, CASE WHEN reg_file IS NOT NULL THEN 'skipped' WHEN ord > first_ord THEN 'skipped' WHEN md5 IS NULL THEN 'failed' "
    "WHEN drive AND canonical IS NOT NULL THEN 'deduplicated' ELSE 'downloaded' END AS status, "
    "CASE WHEN reg_file IS NOT NULL THEN reg_file WHEN ord > first_ord THEN coalesce(canonical, first_own) WHEN md5 IS NULL THEN CASE WHEN drive THEN '' ELSE own END "
    "ELSE coalesce(canonical, own) END AS filename FROM b",
)
def _(spark, sf):
    return R.classify_downloads(_links(spark, sf), seeds.registry(spark, sf))


@query(
    "j07_dry_run",
    f"WITH l AS ({_LINKS}) SELECT l.ord, l.slug AS policy_slug, l.url, CASE WHEN r.filename IS NOT NULL THEN 'skipped' ELSE 'dry_run' END AS status, "
    f"coalesce(r.filename, '?') AS filename FROM l LEFT JOIN (SELECT * FROM ({REGISTRY_SQL}) WHERE present) r USING (key)",
)
def _(spark, sf):
    return R.classify_downloads(_links(spark, sf), seeds.registry(spark, sf), dry_run=True)


@query(
    "j08_unregistered_files",
    "SELECT '_migrated_' || f AS key, NULL::varchar AS source_url, 'f' || doc_id AS policy_slug, f AS filename, 'm' AS downloaded_at, "
    "n_chars AS size_bytes, md5(text) AS md5 FROM (SELECT *, 'f' || doc_id || '.pdf' AS f FROM documents) "
    f"WHERE f NOT IN (SELECT filename FROM ({REGISTRY_SQL}))",
)
def _(spark, sf):
    files = table(spark, sf, "documents").select(
        F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.col("n_chars").alias("size_bytes"), F.md5("text").alias("md5"), F.lit("m").alias("mtime"),
    )
    return R.unregistered_files(files, seeds.registry(spark, sf))


@query(
    "j09_missing_downloads",
    f"SELECT slug, url FROM ({_LINKS}) WHERE contains(url, 'drive.google.com') AND slug NOT IN (SELECT 'doc-' || doc_id FROM labels)",
)
def _(spark, sf):
    return R.missing_downloads(seeds.policy_pdfs(spark, sf), seeds.registry(spark, sf))


@query(
    "j10_pages_with_pictures",
    "SELECT doc_id AS doc, page, 'img-' || page || '-0.png' AS filename FROM (SELECT doc_id, unnest([1, 2, 3]) AS page FROM documents) "
    "WHERE (doc_id + page) % 3 = 0",
)
def _(spark, sf):
    pages = table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page"), "text"
    )
    marked = (F.col("doc") + F.col("page")) % 3 == 0
    texts = pages.withColumn(
        "text", F.when(marked, F.concat("text", F.lit("----- Start of picture text -----"))).otherwise(F.col("text"))
    )
    images = pages.select(
        "doc", "page", F.concat(F.lit("img-"), F.col("page").cast("string"), F.lit("-0.png")).alias("filename")
    )
    return R.pages_with_pictures(images, texts)


@query(
    "g32_dedupe_by_content",
    "SELECT doc_id, md5(text) AS md5, min(doc_id) OVER (PARTITION BY md5(text)) AS canonical, "
    "min(doc_id) OVER (PARTITION BY md5(text)) <> doc_id AS is_duplicate FROM documents",
)
def _(spark, sf):
    return R.dedupe_by_content(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", "md5", "canonical", "is_duplicate"
    )


# --- images and headings ----------------------------------------------------

_IMG_NAME = (
    "CASE user_id % 4 WHEN 0 THEN 'img-00' || user_id % 3 || '-' || lpad(event_id::varchar, 7, '0') || '.jpg' "
    "WHEN 1 THEN 'cover' || event_id || '.png' WHEN 2 THEN 'img-x-' || event_id || '.png' "
    "ELSE 'img-010-' || event_id || '.png' END"
)
_IMG_PAGE = "CASE user_id % 4 WHEN 0 THEN user_id % 3 WHEN 3 THEN 10 ELSE 0 END"
MANIFEST_SQL = (
    "SELECT user_id AS doc, row_number() OVER (PARTITION BY user_id ORDER BY page, filename) AS n, page, filename FROM "
    f"(SELECT user_id, ({_IMG_PAGE})::int AS page, {_IMG_NAME} AS filename FROM events)"
)


def _images(spark: SparkSession, sf: str) -> DataFrame:
    u, e = F.col("user_id"), F.col("event_id").cast("string")
    name = (
        F.when(u % 4 == 0, F.concat(F.lit("img-00"), (u % 3).cast("string"), F.lit("-"), F.lpad(e, 7, "0"), F.lit(".jpg")))
        .when(u % 4 == 1, F.concat(F.lit("cover"), e, F.lit(".png")))
        .when(u % 4 == 2, F.concat(F.lit("img-x-"), e, F.lit(".png")))
        .otherwise(F.concat(F.lit("img-010-"), e, F.lit(".png")))
    )
    return table(spark, sf, "events").select(
        u.alias("doc"), name.alias("filename"), F.lit(1).cast("bigint").alias("size_bytes")
    )


@query("w02_image_manifest", MANIFEST_SQL)
def _(spark, sf):
    return R.image_manifest(_images(spark, sf)).drop("size_bytes")


@query("w02_changed_manifests", "SELECT DISTINCT user_id AS doc FROM events WHERE user_id % 5 = 0")
def _(spark, sf):
    new = R.image_manifest(_images(spark, sf))
    renamed = F.when(F.col("doc") % 5 == 0, F.concat(F.lit("x"), "filename")).otherwise(F.col("filename"))
    return R.changed_manifests(new, new.withColumn("filename", renamed))


@query(
    "w01_nth_block_to_nth_image",
    f"SELECT doc, b.n, block, filename FROM (SELECT doc_id AS doc, unnest([1, 2])::bigint AS n, unnest(['a', 'b']) AS block FROM documents) b "
    f"LEFT JOIN ({MANIFEST_SQL}) m USING (doc, n)",
)
def _(spark, sf):
    start, end = "**----- Start of picture text -----**<br>\n", "**----- End of picture text -----**<br>\n"
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc"),
        F.concat("text", F.lit(f"\n{start}a{end}mid\n{start}b{end}")).alias("md"),
    )
    rows = R.nth_block_to_nth_image(docs, R.image_manifest(_images(spark, sf)))
    return rows.withColumn("block", F.regexp_extract("block", r"\n(.)\*\*", 1))


@query(
    "w03_next_heading",
    "SELECT doc_id AS doc, 1::bigint AS line_no, 'A' AS heading, '1. B' AS next_heading FROM documents UNION ALL "
    "SELECT doc_id, 4, '1. B', NULL FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc"), F.concat(F.lit("## **A**\n\n \n# **1. B** \n"), "text").alias("md")
    )
    return R.next_headings(docs)


# --- set operations ---------------------------------------------------------

_FEEDS = {
    "blog-post": (R02_SQL, "title", "date"),
    "event": (R03_SQL, "title", "date"),
    "team-member": (R04_SQL, "name", "''"),
    "policy": (R01_SQL, "title", "''"),
}
INDEX_SQL = " UNION ALL ".join(
    [f"SELECT slug, content_type, source_id, source_url, {t} AS title, {d} AS date FROM ({sql})" for sql, t, d in _FEEDS.values()]
    + [f"SELECT slug, content_type, source_id, source_url, title, date FROM ({R06_SQL})",
       f"SELECT slug, content_type, source_id, source_url, title, '' FROM ({R05_SQL})",
       f"SELECT slug, content_type, source_id, source_url, title, '' FROM ({_r07('')})"]
)


def items(spark: SparkSession, sf: str) -> DataFrame:
    return N.all_items(
        policies(spark, sf),
        N.clean_blog_posts(seeds.blog_md(spark, sf), CLEANED_AT),
        N.clean_news(seeds.news_md(spark, sf).select("slug", "raw"), CLEANED_AT),
        N.clean_events(seeds.event_md(spark, sf), CLEANED_AT),
        N.clean_team(seeds.member_md(spark, sf), CLEANED_AT),
        N.clean_party_info(seeds.policy_md(spark, sf).select("slug", "raw"), CLEANED_AT),
        N.clean_pdf_documents(seeds.pdf_files(spark, sf), CLEANED_AT),
    )


@query(
    "u01_all_items",
    f"SELECT content_type, slug, body FROM ({R01_SQL}) UNION ALL SELECT content_type, slug, body FROM ({R02_SQL}) UNION ALL "
    f"SELECT content_type, slug, body FROM ({R06_SQL}) UNION ALL SELECT content_type, slug, body FROM ({R03_SQL}) UNION ALL "
    f"SELECT content_type, slug, body FROM ({R04_SQL}) UNION ALL SELECT content_type, slug, body FROM ({R05_SQL}) UNION ALL "
    f"SELECT content_type, slug, body FROM ({_r07('')})",
)
def _(spark, sf):
    return items(spark, sf).select("content_type", "slug", "body")


@query("u02_clean_index", INDEX_SQL)
def _(spark, sf):
    return N.clean_index(items(spark, sf))


@query("u03_known_minus", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _(spark, sf):
    known = table(spark, sf, "labels").select("doc_id")
    return table(spark, sf, "documents").select("doc_id").join(known, "doc_id", "left_anti")


_WORDS = "SELECT DISTINCT lower(unnest(regexp_extract_all(strip_accents(text), '[A-Za-z0-9]+'))) AS word FROM "


@query("u04_word_intersection", f"{_WORDS} documents INTERSECT {_WORDS} benchmark")
def _(spark, sf):
    from corpusloom.functions import compare as V

    def words(name: str) -> DataFrame:
        found = V.with_tokens(table(spark, sf, name), {"t": "text"})
        return found.select(F.explode(V.unique_words(F.col("t"))).alias("word"))

    return words("documents").intersect(words("benchmark"))


# --- snapshots --------------------------------------------------------------

_TTL = (
    "CASE category WHEN 'policies' THEN 86400 WHEN 'team' THEN 86400 WHEN 'party-info' THEN 86400 "
    "WHEN 'blog' THEN 21600 WHEN 'events' THEN 7200 ELSE 43200 END"
)
_HIT = (
    f"coalesce(epoch(TIMESTAMP '{AS_OF}') - epoch(try_cast(cached_at AS TIMESTAMP)) < {_TTL}, false) AND category <> 'team'"
)


@query("s02_fresh_snapshots", f"SELECT event_id, url, category, cached_at, content FROM ({SNAPSHOT_SQL}) WHERE {_HIT}")
def _(spark, sf):
    return S.fresh_snapshots(seeds.snapshots(spark, sf), AS_OF, refresh=("team",))


@query("s03_ttl_dim", f"SELECT category, ({_TTL})::int AS ttl, count(*) AS n FROM ({SNAPSHOT_SQL}) GROUP BY 1, 2")
def _(spark, sf):
    rows = seeds.snapshots(spark, sf)
    return rows.groupBy("category", S.ttl_of(F.col("category")).alias("ttl")).agg(F.count("*").alias("n"))


@query(
    "s04_upsert_snapshots",
    f"SELECT category, left(sha256(url), 16) AS url_key, url, cached_at, event_id, content FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY category, url ORDER BY cached_at DESC, event_id DESC) AS rn FROM ({SNAPSHOT_SQL})) WHERE rn = 1",
)
def _(spark, sf):
    snaps = seeds.snapshots(spark, sf)
    old, new = snaps.filter("event_id % 2 = 0"), snaps.filter("event_id % 2 = 1")
    return S.upsert_snapshots(old, new, "event_id")


@query("s05_invalidate_snapshots",
       f"SELECT event_id, (SELECT count(*) FROM ({SNAPSHOT_SQL}) WHERE category IN ('blog', 'misc')) AS removed "
       f"FROM ({SNAPSHOT_SQL}) WHERE category NOT IN ('blog', 'misc')")
def _(spark, sf):
    kept, removed = S.invalidate_snapshots(seeds.snapshots(spark, sf), ("blog", "misc"))
    return kept.select("event_id", removed.scalar().alias("removed"))


_STATS = (
    "count(*) AS entries, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, "
    "(count(*) FILTER (hit) * 100 // count(*))::bigint AS hit_rate"
)


@query(
    "s06_snapshot_stats",
    f"WITH t AS (SELECT CASE category WHEN 'misc' THEN 'other' ELSE category END AS category, {_HIT} AS hit FROM ({SNAPSHOT_SQL})) "
    f"SELECT category, {_STATS} FROM t GROUP BY category UNION ALL SELECT 'TOTAL', {_STATS} FROM t",
)
def _(spark, sf):
    return S.snapshot_stats(S.with_freshness(seeds.snapshots(spark, sf), AS_OF, refresh=("team",)))


_LATEST = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category, url ORDER BY cached_at DESC, event_id DESC) AS rn "
    f"FROM ({SNAPSHOT_SQL})) WHERE rn = 1"
)


def snapshot_log(spark: SparkSession, sf: str) -> SnapshotLog:
    """All snapshots, appended in two batches."""
    snaps = seeds.snapshots(spark, sf)
    log = SnapshotLog(spark, scratch(spark, "snapshots"), snaps.schema, "event_id")
    for rest in (0, 1):
        log.append(snaps.filter(F.col("event_id") % 2 == rest))
    return log


@query("s02_fresh_of_log", f"SELECT event_id, url, category, cached_at FROM ({_LATEST}) WHERE {_HIT}")
def _(spark, sf):
    """Fresh among the newest; days beyond the time to live are not read."""
    rows = snapshot_log(spark, sf).fresh(AS_OF, refresh=("team",))
    return rows.select("event_id", "url", "category", "cached_at")


@query(
    "s04_compacted_log",
    f"SELECT category, left(sha256(url), 16) AS url_key, url, cached_at, event_id, content FROM ({_LATEST})",
)
def _(spark, sf):
    log = snapshot_log(spark, sf)
    log.compact()
    return log.read()


@query(
    "s05_invalidated_log",
    f"SELECT event_id, (SELECT count(*) FROM ({_LATEST}) WHERE category IN ('blog', 'misc')) AS removed "
    f"FROM ({_LATEST}) WHERE category NOT IN ('blog', 'misc')",
)
def _(spark, sf):
    log = snapshot_log(spark, sf)
    removed = log.invalidate(("blog", "misc"))
    return log.read().select("event_id", F.lit(removed).cast("bigint").alias("removed"))


@query(
    "s06_log_stats",
    f"WITH t AS (SELECT CASE category WHEN 'misc' THEN 'other' ELSE category END AS category, {_HIT} AS hit FROM ({_LATEST})) "
    f"SELECT category, {_STATS} FROM t GROUP BY category UNION ALL SELECT 'TOTAL', {_STATS} FROM t",
)
def _(spark, sf):
    return snapshot_log(spark, sf).stats(AS_OF, refresh=("team",))


# --- sources and sinks ------------------------------------------------------


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the session's checkpoints, which every executor can reach."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def indexed_store(spark: SparkSession, rows: DataFrame, sections: DataFrame | None = None) -> writers.Store:
    """Items and sections in a store with a text index, written in two halves so that the second keeps it up."""
    path = scratch(spark, "indexed")
    items = schemas.conform(rows)
    half = F.pmod(F.xxhash64("slug"), F.lit(2))
    writers.write_clean_items(items.filter(half == 0), path, 4)
    writers.index_store(spark, path)
    writers.write_clean_items(items.filter(half == 1), path, 4, sections)
    return writers.read_store(spark, path)


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Items as the stored table that searches read, partitioned by content type."""
    path = scratch(spark, "clean")
    schemas.conform(rows).write.partitionBy("content_type").parquet(path)
    return spark.read.parquet(path)


@query("s08_scan_json_index",
       "SELECT 'd' || doc_id AS slug, source AS title, '' AS date FROM documents")
def _(spark, sf):
    path = scratch(spark, "index")
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("slug"),
        F.col("source").alias("title"), F.lit("").alias("date"),
    )
    docs.write.json(path)
    return readers.scan_json_index(spark, path, schemas.INDEX_ENTRY).select("slug", "title", "date")


@query(
    "s09_scan_jsonl_lenient",
    "SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 'u' || event_id ELSE 'e' || event_id END AS id, CASE WHEN event_id % 4 = 2 THEN 'Y' "
    "WHEN event_id % 4 = 1 THEN 'u' || event_id ELSE event_type END AS title, CASE WHEN event_id % 4 = 3 THEN 'http://v/' || event_id WHEN event_id % 4 = 1 THEN "
    "'https://v.example.org/u' || event_id ELSE 'https://v.example.org/e' || event_id END AS url, json_extract_string(props, '$.k')::bigint AS duration "
    "FROM events WHERE event_id % 10 <> 0",
)
def _(spark, sf):
    e, n = F.col("event_id").cast("string"), F.col("event_id") % 4
    ident = F.when(n == 1, F.concat(F.lit('"url": "u'), e, F.lit('"'))).otherwise(
        F.concat(F.lit('"id": "e'), e, F.lit('"'))
    )
    title = (
        F.when(n == 1, "").when(n == 2, ', "ie_key": "Y"')
        .otherwise(F.concat(F.lit(', "title": "'), "event_type", F.lit('"')))
    )
    url = F.when(n == 3, F.concat(F.lit(', "url": "http://v/'), e, F.lit('"'))).otherwise("")
    k = F.get_json_object("props", "$.k")
    line = F.concat(F.lit("  {"), ident, title, url, F.lit(', "duration": '), k, F.lit("}"))
    bad = F.when(F.col("event_id") % 20 == 0, "").otherwise("{broken")
    lines = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, bad).otherwise(line).alias("line")
    )
    path = scratch(spark, "lines")
    lines.select("line").write.text(path)
    rows = readers.scan_jsonl_lenient(spark, path, "videos", "https://v.example.org/")
    number = F.regexp_extract("id", "[0-9]+", 0).cast("bigint")
    return rows.select(number.alias("event_id"), "id", "title", "url", "duration")


_MD_SQL = (
    "'---' || chr(10) || 'slug: \"' || slug || '\"' || chr(10) || 'content_type: \"team-member\"' || chr(10) || "
    f"'source_id: \"{rules.SOURCE_ID}\"' || chr(10) || 'source_type: \"{rules.SOURCE_TYPE}\"' || chr(10) || 'source_url: \"' || source_url || '\"' || chr(10) || "
    f"'ingested_at: \"' || ingested_at || '\"' || chr(10) || 'cleaned_at: \"{CLEANED_AT}\"' || chr(10) || 'name: \"' || name || '\"' || chr(10) || "
    "'role: \"' || role || '\"' || chr(10) || CASE WHEN electorate <> '' THEN 'electorate: \"' || electorate || '\"' || chr(10) ELSE '' END || '---' || chr(10) || "
    "ltrim(body, chr(10))"
)


@query("s10_scan_item_files", f"SELECT content_type, slug, title, date, {d_strip('body')} AS body FROM ({R02_SQL})")
def _(spark, sf):
    """Posts written as a folder each and read back."""
    path = scratch(spark, "folders")
    posts = schemas.conform(N.clean_blog_posts(seeds.blog_md(spark, sf), CLEANED_AT))
    write_item_folders(writers.with_rendered(posts), path)
    return readers.scan_item_files(spark, path).select(
        "content_type", "slug", F.get_json_object("meta", "$.title").alias("title"),
        F.get_json_object("meta", "$.date").alias("date"), strip(F.col("body")).alias("body"),
    )


@query("s11_write_clean_items", f"SELECT slug, role, {_MD_SQL} AS rendered_md FROM ({R04_SQL})")
def _(spark, sf):
    path = scratch(spark, "items")
    team = schemas.conform(N.clean_team(seeds.member_md(spark, sf), CLEANED_AT))
    writers.write_clean_items(team.withColumn("role", F.lit("stale")), path, buckets=4)
    writers.write_clean_items(team, path, buckets=4)
    return writers.read_clean_items(spark, path).select("slug", "role", "rendered_md")


@query("s12_write_index",
       f"SELECT slug, content_type, source_id, source_url, name AS title, '' AS date FROM ({R04_SQL})")
def _(spark, sf):
    path = scratch(spark, "catalogue")
    writers.write_index(schemas.conform(N.clean_team(seeds.member_md(spark, sf), CLEANED_AT)), path)
    return readers.scan_json_index(spark, path, schemas.INDEX_ENTRY)


@query(
    "s13_write_raw_records",
    "SELECT file_key, max_by(doc_id, doc_id) AS doc_id FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE '2026-01-0' || doc_id % 9 + 1 || '-' END || "
    "source || '-x' AS file_key FROM documents) GROUP BY file_key",
)
def _(spark, sf):
    records = table(spark, sf, "documents").select(
        "doc_id", F.concat("source", F.lit(" X!")).alias("title"),
        F.when(F.col("lang") == "en", "").otherwise(
            F.concat(F.lit("2026-01-0"), (F.col("doc_id") % 9 + 1).cast("string"))
        ).alias("date"),
    )
    path = scratch(spark, "raw")
    writers.write_raw_records(records.withColumn("ord", F.col("doc_id")), "blog-post", "ord", path)
    return spark.read.parquet(path).select("file_key", "doc_id")


@query("s15_rebuild_site_tables", f"SELECT slug, {d_collapse(_SITE_TEAM)} AS md FROM ({MEMBER_MD_SQL})")
def _(spark, sf):
    path = scratch(spark, "site")
    writers.rebuild_site_tables(
        schemas.conform(N.clean_team(seeds.member_md(spark, sf), CLEANED_AT)), path
    )
    return spark.read.parquet(f"{path}/team").select("slug", "md")


_DETAIL_SQL = (
    f"SELECT replace(policy_slug, 'pol-', 'page-') AS slug, file, {d_strip(PDF_BODY_SQL)} AS detail FROM ({PDF_FILE_SQL})"
)
_SECTION_SQL = (
    "SELECT slug, file, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY file) = 1 AND slug IN "
    f"(SELECT 'page-' || page_id FROM pages) THEN '{rules.DETAIL_HEADING}' || chr(10) || chr(10) ELSE '' END || detail AS md "
    f"FROM ({_DETAIL_SQL}) WHERE detail <> ''"
)


@query("s15_site_policy_sections", f"SELECT slug, file, {d_collapse('md')} AS md FROM ({_SECTION_SQL})")
def _(spark, sf):
    """Policies stored with their PDF text over a stale version of it, read back and published."""
    path = scratch(spark, "policies")
    raw, pdfs = seeds.policy_md(spark, sf).select("slug", "raw"), _page_pdfs(spark, sf)
    items, sections = schemas.conform(policies(spark, sf)), N.policy_sections(pdfs, raw)
    writers.write_clean_items(items, path, 4, sections.withColumn("file", F.concat(F.lit("stale-"), "file")))
    writers.write_clean_items(items, path, 4, sections)
    writers.rebuild_site_tables(writers.read_store(spark, path), f"{path}-site")
    return spark.read.parquet(f"{path}-site/policy-sections").select("slug", "file", "md")


@query("st1_incremental_clean", f"SELECT slug, name, role, body FROM ({R04_SQL})")
def _(spark, sf):
    path = scratch(spark, "incremental")
    seeds.member_md(spark, sf).write.parquet(f"{path}/raw")
    raw = spark.readStream.schema(spark.read.parquet(f"{path}/raw").schema).parquet(f"{path}/raw")

    def clean(batch: DataFrame) -> DataFrame:
        return schemas.conform(N.clean_team(batch, CLEANED_AT))

    incremental_clean(raw, clean, f"{path}/items", f"{path}/progress", buckets=4).awaitTermination()
    return writers.read_clean_items(spark, f"{path}/items").select("slug", "name", "role", "body")


@query("st2_first_seen_stream", "SELECT DISTINCT user_id FROM events")
def _(spark, sf):
    path = scratch(spark, "seen")
    source = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    source.write.parquet(f"{path}/events")
    stream = spark.readStream.schema(spark.read.parquet(f"{path}/events").schema).parquet(f"{path}/events")
    (
        first_seen_stream(stream, "user_id", "ts", "60 days")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/progress")
        .option("path", f"{path}/out")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{path}/out").select("user_id")


@query("st2_first_seen_ever", "SELECT user_id, 1::bigint AS kept FROM events GROUP BY user_id")
def _(spark, sf):
    """Events landed in several files, one a batch, in any order; a user counts once, however far apart."""
    path = scratch(spark, "ever")
    table(spark, sf, "events").select("user_id", "event_id").repartition(4, "event_id").write.parquet(f"{path}/events")
    schema = spark.read.parquet(f"{path}/events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
    first_seen_ever(stream, "user_id", ["event_id"], f"{path}/table", f"{path}/progress", buckets=4).awaitTermination()
    return read_first_seen(spark, f"{path}/table", schema).groupBy("user_id").agg(F.count("*").alias("kept"))


# --- extension points -------------------------------------------------------


@query(
    "k01_added_rule",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, 'th', 'TH') ELSE text END AS text FROM documents",
)
def _(spark, sf):
    """A rule added to the book of one key; rows of other keys pass through."""
    from corpusloom.functions import repair as Q

    book = Q.add_rule({}, "own.md", "shout", lambda t: F.replace(t, F.lit("th"), F.lit("TH")))
    key = F.when(F.col("doc_id") % 2 == 0, "own.md").otherwise("other.md")
    return table(spark, sf, "documents").select(
        "doc_id", Q.apply_rules(key, F.col("text"), book).alias("text"))


@query(
    "k01_python_rule",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN reverse(text) ELSE text END AS text FROM documents",
)
def _(spark, sf):
    """A rule that is a plain function of a text."""
    from corpusloom.functions import repair as Q

    book = Q.add_rule({}, "own.md", "turn round", Q.PythonRule(lambda t: t[::-1]))
    key = F.when(F.col("doc_id") % 2 == 0, "own.md").otherwise("other.md")
    rows = table(spark, sf, "documents").select("doc_id", "text", key.alias("key"))
    return Q.repaired(rows, "key", "text", book).drop("key")


@query(
    "k01_rule_faults",
    "WITH t AS (SELECT coalesce(text, '') AS t, text IS NULL AS none FROM documents WHERE doc_id % 2 = 0) "
    "SELECT 'own.md' AS key, 0 AS ord, 'add a mark' AS description, count(*) AS rows, count(*) FILTER (NOT none) AS changed, "
    "0::bigint AS not_repeatable, count(*) FILTER (NOT none) AS not_idempotent FROM t "
    "UNION ALL SELECT 'own.md', 1, 'drop marks', count(*), count(*) FILTER (NOT none), 0, 0 FROM t",
)
def _(spark, sf):
    """A rule that adds to its own result is found, one that drops is not."""
    from corpusloom.functions import repair as Q

    book = Q.add_rule({}, "own.md", "add a mark", lambda t: F.concat(t, F.lit("\u2020")))
    book = Q.add_rule(book, "own.md", "drop marks", Q.PythonRule(lambda t: t.replace("\u2020", "")))
    key = F.when(F.col("doc_id") % 2 == 0, "own.md").otherwise("other.md")
    return Q.rule_faults(table(spark, sf, "documents").select(key.alias("key"), "text"), "key", "text", book)


@query(
    "k02_media_platform",
    f"SELECT {_YEAR} AS year, id FROM ({S16_SQL})",
)
def _(spark, sf):
    """A platform is an object with two methods; grouping works on what it lists."""
    class Channel:
        def enumerate(self, session: SparkSession) -> DataFrame:
            return R.enumerate_media(media(session, sf))

        def group(self, rows: DataFrame) -> DataFrame:
            return R.group_by_year(rows)

    platform: source_registry.MediaPlatform = Channel()
    return platform.group(platform.enumerate(spark)).select("year", "id")


@query(
    "k03_second_source",
    f"SELECT content_type, slug, body FROM ({R02_SQL}) UNION ALL SELECT 'policy', 'own-' || doc_id, text FROM documents",
)
def _(spark, sf):
    """Items of two registered sources in one table; the second brings its own projection."""
    def own(session: SparkSession) -> DataFrame:
        given = {c: F.lit("s") for c in schemas.PROVENANCE if c not in ("slug", "content_type")}
        return table(session, sf, "documents").select(
            F.concat(F.lit("own-"), F.col("doc_id").cast("string")).alias("slug"),
            F.lit("policy").alias("content_type"), F.col("text").alias("body"), F.col("source").alias("title"),
        ).withColumns(given)

    names = [f"{n}-{uuid.uuid4().hex}" for n in ("posts", "own")]
    source_registry.register_source(names[0], lambda s: N.clean_blog_posts(seeds.blog_md(s, sf), CLEANED_AT))
    source_registry.register_source(names[1], own)
    return source_registry.run_sources(spark, names).select("content_type", "slug", "body")
