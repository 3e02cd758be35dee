"""Queries over pages: regions, text, markdown, titles, links, cards, feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import html as H
from corpusloom.functions import markdown as M
from corpusloom.functions import text as X
from corpusloom.operators import links as L
from corpusloom.plans import seeds
from corpusloom.plans.book import (
    d_drop_boilerplate,
    d_element,
    d_entities,
    d_has,
    d_strip,
    d_sub,
    d_text,
    d_title,
    query,
    table,
)
from corpusloom.plans.item_queries import scratch
from corpusloom.plans.seeds import BASE, LINKED_SQL
from corpusloom.sources.readers import scan_feeds, scan_pages

_ARTICLE = d_element("html", "article")
_BODY = d_drop_boilerplate(d_element("html", "body"))


@query("s01_scan_pages", "SELECT page_id, url, 'policies' AS category, html FROM pages")
def _(spark, sf):
    return scan_pages(spark, f"{sf}/pages.parquet", "policies")


@query(
    "h01_main_content",
    f"SELECT page_id, CASE WHEN length({d_text(_ARTICLE)}) > 1000 THEN {_ARTICLE} ELSE {_BODY} END "
    f"AS strict, CASE WHEN length({d_text(_ARTICLE)}) > 50 THEN {_ARTICLE} ELSE '' END AS loose "
    "FROM pages",
)
def _(spark, sf):
    html = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id",
        H.main_content(html, 1000, fall_back=True).alias("strict"),
        H.main_content(html, 50).alias("loose"),
    )


@query(
    "h02_main_text",
    f"SELECT page_id, CASE WHEN length({d_text(_ARTICLE)}) > 1000 THEN {d_text(_ARTICLE, 'chr(10)')} "
    f"ELSE {d_text(_BODY, 'chr(10)')} END AS text FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.main_text(F.col("html"), 1000).alias("text")
    )


@query("h03_html_text", f"SELECT page_id, {d_text('html', chr(39) + '|' + chr(39))} AS text FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.html_text(F.col("html"), "|").alias("text")
    )


@query("h04_drop_boilerplate", f"SELECT page_id, {d_drop_boilerplate('html')} AS html FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.drop_boilerplate(F.col("html")).alias("html")
    )


@query(
    "h01_nested_content",
    f"SELECT page_id, CASE WHEN length({d_text(_ARTICLE)}) > 50 THEN '<main>inner</main>' || {_ARTICLE} ELSE '' END AS html FROM pages",
)
def _(spark, sf):
    """A region that holds another of its name, before the page's own, and one after it."""
    page = F.concat(F.lit("<body><main id='m'><main>inner</main>"), H.element(F.col("html"), "article"),
                    F.lit("</main><main>other</main></body>"))
    own = F.length(H.html_text(H.element(F.col("html"), "article"))) > 50
    return table(spark, sf, "pages").select(
        "page_id", F.when(own, H.main_content(page, 50)).otherwise("").alias("html"))


@query("h04_nested_boilerplate", f"SELECT page_id, {d_drop_boilerplate('html')} AS html FROM pages")
def _(spark, sf):
    """Boilerplate that holds boilerplate goes as a whole, so the page is left as without it."""
    nested = F.replace("html", F.lit("</nav>"), F.lit("<ul><nav class='x'>in</nav>out</ul><header>h</header></nav>"))
    return table(spark, sf, "pages").select("page_id", H.drop_boilerplate(nested).alias("html"))


def _d_markdown(x: str) -> str:
    x = d_sub(x, r"[\t \r\n]+", " ")
    x = d_sub(x, r"([*_])", r"\\\1")
    x = d_sub(x, r"(?is)<(?:b|strong)>\s*([^<>]+?)\s*</(?:b|strong)\s*>", r"**\1**")
    x = d_sub(x, r"(?is)<h1\b[^>]*>\s*(.*?)\s*</h1\s*>", "\n\n# \\1\n\n")
    x = d_sub(x, r"(?i)<br\b[^>]*>", "  \n")
    x = d_sub(x, r"(?i)</?(?:p|ul|ol|div|section|article)\b[^>]*>", "\n\n")
    x = d_entities(d_sub(x, r"(?s)<[^>]*>", ""))
    return d_strip(d_sub(d_sub(x, r"\n ", "\n"), r"\n{3,}", "\n\n"))


@query("h05_html_to_markdown", f"SELECT page_id, {_d_markdown(_ARTICLE)} AS md FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", H.html_to_markdown(H.element(F.col("html"), "article")).alias("md")
    )


_TITLE_SQL = (
    f"CASE WHEN {d_has('html', '(?is)<h1')} THEN {d_text(d_element('html', 'h1'))} "
    f"WHEN {d_has('html', '(?is)<title')} THEN "
    f"{d_strip('split_part(' + d_text(d_element('html', 'title')) + ', chr(124), 1)')} "
    "ELSE 'Unknown' END"
)


@query(
    "h06_page_title",
    f"SELECT page_id, {_TITLE_SQL} AS title, {d_strip('split_part(' + d_text(d_element('html', 'title')) + ', chr(124), 1)')} AS title_tag "
    "FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        H.page_title(F.col("html")).alias("title"),
        H.title_tag(F.col("html")).alias("title_tag"),
    )


@query(
    "h07_person_title",
    f"SELECT c_custkey, name || ' Jr.' AS title FROM ({seeds.MEMBER_SQL})",
)
def _(spark, sf):
    return seeds.profile_pages(spark, sf).select(
        "c_custkey", H.person_title(F.col("html")).alias("title")
    )


_A = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""
_A_LIT = _A.replace("'", "''")


def _d_links(source: str) -> str:
    return (
        "SELECT page_id, (i - 1)::bigint AS ord, "
        f"{d_entities('regexp_extract(a, ' + chr(39) + _A_LIT + chr(39) + ', 1)')} AS href, "
        f"{d_text('regexp_extract(a, ' + chr(39) + _A_LIT + chr(39) + ', 2)')} AS text "
        f"FROM (SELECT page_id, unnest(x) AS a, generate_subscripts(x, 1) AS i FROM "
        f"(SELECT page_id, regexp_extract_all(html, '{_A_LIT}', 0) AS x FROM {source}))"
    )


LINKS_SQL = _d_links(f"({LINKED_SQL})")


@query("h08_links", _d_links("pages"))
def _(spark, sf):
    return L.links(table(spark, sf, "pages")).select("page_id", "ord", "href", "text")


@query(
    "h09_pdf_links",
    f"SELECT page_id, ord, href FROM ({LINKS_SQL}) WHERE contains(href, 'drive.google.com') "
    "OR ends_with(lower(href), '.pdf')",
)
def _(spark, sf):
    return L.pdf_links(L.links(seeds.linked_pages(spark, sf))).select("page_id", "ord", "href")


@query(
    "h10_labelled_pdf_links",
    "SELECT page_id, 'annual-report-' || page_id % 9 AS label, "
    "'https://drive.google.com/file/d/ID' || page_id || '/view' AS href FROM pages",
)
def _(spark, sf):
    return L.labelled_pdf_links(seeds.linked_pages(spark, sf))


@query(
    "h10_nested_lists",
    "SELECT page_id, 'annual-report-' || page_id % 9 AS label, 'https://drive.google.com/file/d/ID' || page_id || '/view' AS href "
    "FROM pages, range(2)",
)
def _(spark, sf):
    """A list in a list: the outer entry holds the link of the inner one, so either is labelled."""
    inner = F.regexp_replace("html", r"(?is)(<li\b[^>]*>.*?</li\s*>)", "<li><ul>$1</ul>after</li>")
    return L.labelled_pdf_links(seeds.linked_pages(spark, sf).withColumn("html", inner))


@query(
    "h11_discover_new_links",
    "SELECT DISTINCT 'p' || page_id % 20 AS slug, '/policy/p' || page_id % 20 AS path FROM pages "
    "WHERE page_id % 20 NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)",
)
def _(spark, sf):
    known = table(spark, sf, "nation").filter("n_regionkey = 0").select(
        F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("slug")
    )
    return L.discover_new_links(L.links(seeds.linked_pages(spark, sf)), known, "/policy/")


@query(
    "h12_keyword_sublinks",
    f"SELECT page_id, name, max_by(href, ord) AS href FROM (SELECT *, CASE WHEN text <> '' THEN text "
    f"ELSE replace(list_last(string_split(trim(href, '/'), '/')), '-', ' ') END AS name FROM ({LINKS_SQL}) "
    "WHERE regexp_matches(lower(href), 'constitution|governance|registration|rules|/th')) "
    "GROUP BY page_id, name",
)
def _(spark, sf):
    keywords = (*rules.SUBLINK_KEYWORDS, "/th")
    return L.keyword_sublinks(L.links(seeds.linked_pages(spark, sf)), keywords)


@query(
    "h13_member_links",
    "SELECT '/candidate-jo-' || k AS href, 'Jo ' || k AS name, min(page_id) AS page_id FROM "
    "(SELECT page_id, page_id % 50 AS k FROM pages) GROUP BY k UNION ALL "
    "SELECT '/candidate-al-' || k, 'Al ' || k, min(page_id) FROM "
    "(SELECT page_id, page_id % 30 AS k FROM pages) GROUP BY k",
)
def _(spark, sf):
    return L.member_links(L.links(seeds.linked_pages(spark, sf))).drop("ord")


@query(
    "h14_classify_role",
    "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Party Leader' WHEN 1 THEN 'Deputy Leader' "
    "ELSE 'Candidate' END AS role FROM customer",
)
def _(spark, sf):
    return seeds.profile_pages(spark, sf).select(
        "c_custkey", H.classify_role(F.col("html")).alias("role")
    )


@query(
    "h15_electorate",
    f"SELECT c_custkey, {d_title('electorate')} AS electorate FROM ({seeds.MEMBER_SQL})",
)
def _(spark, sf):
    return seeds.profile_pages(spark, sf).select(
        "c_custkey", H.electorate(F.col("html")).alias("electorate")
    )


@query(
    "h16_strip_protected_emails",
    "SELECT c_custkey, 'Bio ' AS html_text, 'x  y' AS md FROM customer",
)
def _(spark, sf):
    page = F.regexp_extract(H.strip_protected_links(F.col("html")), "<p>(Bio.*?)</p>", 1)
    md = F.concat(
        F.lit("x [mail [a@"), "slug", F.lit("]](/cdn-cgi/l/email-protection#"), "slug",
        F.lit(") y"),
    )
    return seeds.profile_pages(spark, sf).select(
        "c_custkey", page.alias("html_text"), M.strip_protected_emails(md).alias("md")
    )


@query(
    "h17_event_cards",
    "SELECT page_id, 0::bigint AS ord, 'https://www.example.org/events/' || page_id AS url FROM pages "
    "UNION ALL SELECT page_id, 1, 'https://www.example.org/events/r' || page_id FROM pages",
)
def _(spark, sf):
    return L.event_cards(seeds.card_pages(spark, sf), BASE).select("page_id", "ord", "url")


@query(
    "h17_nested_cards",
    "SELECT page_id, i AS ord, 'Talk ' || page_id || '-' || i AS title, 'https://www.example.org/e/' || page_id || '/' || i AS url "
    "FROM pages, range(2) AS t(i)",
)
def _(spark, sf):
    """Cards that hold elements of their own name, among the page's other markup."""
    def card(i: str) -> list:
        key = F.col("page_id").cast("string")
        return [F.lit("<div class='event-card'><div><div><h3>Talk "), key, F.lit(f"-{i}</h3></div></div><div><a href='/e/"), key,
                F.lit(f"/{i}'>more</a></div></div>")]

    page = F.concat(F.col("html"), *card("0"), F.lit("<div>between</div>"), *card("1"))
    pages = table(spark, sf, "pages").withColumn("html", page)
    return L.event_cards(pages, BASE).select("page_id", "ord", "title", "url")


@query(
    "h18_event_title",
    "SELECT page_id, 0::bigint AS ord, 'Meetup ' || page_id AS title FROM pages "
    "UNION ALL SELECT page_id, 1, 'Big rally ' || page_id FROM pages",
)
def _(spark, sf):
    return L.event_cards(seeds.card_pages(spark, sf), BASE).select("page_id", "ord", "title")


@query(
    "h19_event_date",
    "SELECT page_id, 0::bigint AS ord, '2026-06-' || lpad((page_id % 28 + 1)::varchar, 2, '0') AS date, "
    "'' AS time FROM pages UNION ALL SELECT page_id, 1, '2026-03-' || "
    "lpad((page_id % 28 + 1)::varchar, 2, '0'), '' FROM pages",
)
def _(spark, sf):
    return L.event_cards(seeds.card_pages(spark, sf), BASE).select("page_id", "ord", "date", "time")


@query(
    "h20_event_location",
    "SELECT page_id, 0::bigint AS ord, 'Town ' || page_id % 7 || ', Region' AS location FROM pages "
    "UNION ALL SELECT page_id, 1, 'City Hall' FROM pages",
)
def _(spark, sf):
    return L.event_cards(seeds.card_pages(spark, sf), BASE).select("page_id", "ord", "location")


@query(
    "h21_event_detail",
    "SELECT page_id, '**When**: June ' || page_id || ' at 7pm · 2 hrs' || chr(10) || '**Venue**: Hall ' "
    "|| page_id || chr(10) || '**Address**: ' || page_id || ' Queen St' || chr(10) || chr(10) || "
    "'Come along' AS detail FROM pages",
)
def _(spark, sf):
    key = F.col("page_id").cast("string")
    detail = F.concat(
        F.lit('<main><section class="event-header"><div><span class="event-header-column-headline">'
              'When</span><p><i class="fa fa-calendar"></i> June '), key,
        F.lit(' at 7pm</p><p><i class="fa fa-clock"></i> 2 hrs</p></div><div>'
              '<span class="event-header-column-headline">Where</span><h4>Hall '), key,
        F.lit('</h4><a href="https://maps.google.com/?q=1">'), key,
        F.lit(' Queen St</a></div></section><div id="intro"><p>Come along</p><p>RSVP now</p></div>'
              "</main></article>"),
    )
    html = F.replace("html", F.lit("</article>"), detail)
    return table(spark, sf, "pages").select("page_id", H.event_detail(html).alias("detail"))


@query(
    "h22_gate_future_detail",
    "SELECT event_id, CASE WHEN strftime(e.ts, '%Y-%m-%d') >= '2024-01-20' THEN "
    "coalesce(u.description, '') ELSE '' END AS description FROM events e LEFT JOIN "
    "(SELECT user_id, 'n=' || count(*) AS description FROM events GROUP BY user_id) u "
    "ON e.user_id = u.user_id",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("user_id").cast("string").alias("url"),
    )
    details = events.groupBy("url").agg(
        F.concat(F.lit("n="), F.count("*").cast("string")).alias("description")
    )
    return L.gate_future_detail(events, details, "2024-01-20").select("event_id", "description")


@query(
    "h23_authoritative_name",
    "SELECT doc_id, CASE WHEN doc_id % 250 IN (SELECT page_id FROM pages) THEN "
    f"coalesce(nullif(nullif(h, ''), 'Unknown'), source) ELSE source END AS name FROM documents "
    f"LEFT JOIN (SELECT page_id, {_TITLE_SQL} AS h FROM pages) ON page_id = doc_id % 250",
)
def _(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("k"), H.page_title(F.col("html")).alias("page_name")
    )
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.col("doc_id") % 250).alias("k"), F.col("source").alias("name")
    )
    return L.authoritative_name(docs, pages, "k").select("doc_id", "name")


@query(
    "h24_canonical_path",
    "SELECT page_id, CASE WHEN starts_with(p, '/') THEN p ELSE '/' || p END AS path, "
    "'https://www.example.org' || CASE WHEN starts_with(p, '/') THEN p ELSE '/' || p END AS absolute "
    "FROM (SELECT page_id, regexp_replace(url, '^https?://[^/]+', '') AS p FROM pages)",
)
def _(spark, sf):
    path = X.canonical_path(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id", path.alias("path"), F.concat(F.lit(BASE), path).alias("absolute")
    )


@query(
    "h25_drive_file_id",
    f"SELECT page_id, ord, nullif(regexp_extract(href, '/file/d/([A-Za-z0-9_-]+)', 1), '') AS file_id, "
    "coalesce(nullif(regexp_extract(href, '/file/d/([A-Za-z0-9_-]+)', 1), ''), href) AS key "
    f"FROM ({LINKS_SQL})",
)
def _(spark, sf):
    href = F.col("href")
    return L.links(seeds.linked_pages(spark, sf)).select(
        "page_id", "ord", X.drive_file_id(href).alias("file_id"), X.registry_key(href).alias("key")
    )


@query(
    "h26_filename_from_url",
    "SELECT page_id, CASE WHEN ends_with(lower(f), '.pdf') THEN f ELSE f || '.pdf' END AS filename FROM "
    "(SELECT page_id, coalesce(nullif(list_last(string_split(rtrim(regexp_replace(regexp_replace(url, "
    "'^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/'), '/')), ''), 'download.pdf') AS f FROM pages)",
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", X.filename_from_url(F.col("url")).alias("filename")
    )


@query(
    "h27_external_urls",
    f"SELECT page_id, href AS url FROM ({LINKS_SQL}) WHERE regexp_matches(href, '^https?://')",
)
def _(spark, sf):
    return L.external_urls(seeds.linked_pages(spark, sf))


_NAV_HREF = '<li><a href="([^"]*)">'


# Each page is a feed of its links that carries the page as its description; every second feed is malformed.
@query(
    "s07_scan_rss",
    "SELECT page_id AS feed_id, (i - 2)::bigint AS ord, 'Item ' || i AS title, h AS url_path, "
    "CASE WHEN page_id % 5 = 0 THEN '' ELSE '2026-06-' || lpad((page_id % 28 + 1)::varchar, 2, '0') END "
    "AS date, 'Ann ' || page_id AS author FROM (SELECT page_id, unnest(x) AS h, "
    "generate_subscripts(x, 1) AS i FROM (SELECT page_id, "
    f"regexp_extract_all(html, '{_NAV_HREF}', 1) AS x FROM pages)) WHERE i > 1",
)
def _(spark, sf):
    key = F.col("page_id")
    day = (key % 28 + 1).cast("string")
    date = F.when(key % 5 == 0, "soon").otherwise(
        F.concat(F.lit("Mon, "), day, F.lit(" Jun 2026 23:00:00 +1200"))
    )
    hrefs = F.regexp_extract_all("html", F.lit(_NAV_HREF), F.lit(1))
    items = F.transform(
        hrefs,
        lambda h, i: F.concat(
            F.lit("<item><title> Item "), (i + 1).cast("string"), F.lit(" </title><link>"),
            F.when(i == 0, "").otherwise(F.concat(F.lit(BASE), h)),
            F.lit("</link><pubDate>"), date, F.lit("</pubDate><author>Ann "), key.cast("string"),
            F.lit("</author></item>"),
        ),
    )
    about = F.replace(F.replace(F.regexp_replace("html", r"\s+", " "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(
        F.lit("<rss><channel><title>t</title><link>"), key.cast("string"), F.lit("</link><description>"), about,
        F.lit("</description>"), F.array_join(items, ""), F.lit("</channel></rss>"),
    )
    broken = F.lit("<rss><channel><link>broken</link><item><title>x</channel></rss>")
    path = scratch(spark, "feeds")
    table(spark, sf, "pages").select(F.explode(F.array(xml, broken)).alias("xml")).write.text(path)
    return scan_feeds(spark, path).withColumn("feed_id", F.col("feed").cast("bigint")).drop("feed", "file")
