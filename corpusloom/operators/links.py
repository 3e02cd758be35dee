"""Page-level link extraction: rows where rows are the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import html as H
from corpusloom.functions.text import blank_to_null, path_slug
from corpusloom.operators.scale import first_by, lookup_join


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, ord, href, text, inner): every link of the page source in order."""
    return pages.select(key, F.posexplode(H.anchors(F.col("html"))).alias("ord", "a")).select(
        key, F.col("ord").cast("bigint").alias("ord"), "a.href", "a.text", "a.inner"
    )


def pdf_links(page_links: DataFrame, host: str = rules.FILE_HOST) -> DataFrame:
    return page_links.filter(H.is_pdf_link(F.col("href"), host))


def labelled_pdf_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return pages.select(key, F.inline(H.labelled_pdf_links(F.col("html"))))


def discover_new_links(page_links: DataFrame, known: DataFrame, prefix: str) -> DataFrame:
    """(slug, path) of linked pages under a prefix that `known(slug)` lacks."""
    slug = F.btrim(F.replace(F.col("href"), F.lit(prefix), F.lit("")), F.lit("/"))
    found = (
        page_links.filter(F.col("href").startswith(prefix))
        .select(slug.alias("slug"))
        .filter("slug <> ''")
        .distinct()
    )
    return found.join(known.select("slug").distinct(), "slug", "left_anti").withColumn(
        "path", F.concat(F.lit(prefix), F.col("slug"))
    )


def keyword_sublinks(
    page_links: DataFrame, keywords=rules.SUBLINK_KEYWORDS, key: str = "page_id"
) -> DataFrame:
    """(key, name, href) of links naming a keyword; a later duplicate name wins."""
    hit = F.lower(F.col("href")).rlike("|".join(keywords))
    named = page_links.filter(hit).withColumn(
        "name", H.sublink_name(F.col("text"), F.col("href"))
    )
    return named.groupBy(key, "name").agg(F.max_by("href", "ord").alias("href"))


def member_links(page_links: DataFrame, prefix: str = "/candidate-", key: str = "page_id"):
    """First occurrence of each profile link with text, with the best name for it."""
    slug = path_slug(F.replace(F.col("href"), F.lit(prefix), F.lit("")), "")
    wanted = page_links.filter(F.col("href").startswith(prefix) & (F.col("text") != ""))
    first = first_by(wanted.select("href", key, "ord", "inner"), ["href"], F.struct(key, "ord"))
    return first.select("href", key, "ord", H.member_name(F.col("inner"), slug).alias("name"))


def event_cards(pages: DataFrame, base: str, tag: str = "div", key: str = "page_id") -> DataFrame:
    """One row per card with a link: title, url, date, time, location."""
    cards = pages.select(
        key, F.posexplode(H.event_cards(F.col("html"), tag)).alias("ord", "card")
    ).filter(F.size(H.anchors(F.col("card"))) > 0)
    return cards.select(
        key,
        F.col("ord").cast("bigint").alias("ord"),
        H.event_title(F.col("card")).alias("title"),
        H.card_url(F.col("card"), base).alias("url"),
        H.event_date(F.col("card")).alias("date"),
        F.lit("").alias("time"),
        H.event_location(F.col("card")).alias("location"),
    )


def gate_future_detail(events: DataFrame, details: DataFrame, as_of: str) -> DataFrame:
    """Event description only for events on or after `as_of`; `details` is unique by url."""
    later = F.col("date") >= F.lit(as_of)
    gated = events.withColumn("_k", F.when(later, F.col("url")))
    side = details.select(F.col("url").alias("_k"), "description")
    return (
        lookup_join(gated, side, ["_k"])
        .drop("_k")
        .withColumn("description", F.coalesce("description", F.lit("")))
    )


def authoritative_name(members: DataFrame, page_names: DataFrame, key: str) -> DataFrame:
    """A profile page's own heading overrides the name in the listing."""
    joined = lookup_join(members, page_names.select(key, "page_name"), [key])
    own = F.nullif(blank_to_null(F.col("page_name")), F.lit("Unknown"))
    return joined.withColumn("name", F.coalesce(own, F.col("name"))).drop("page_name")


def external_urls(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return pages.select(key, F.explode(H.external_urls(F.col("html"))).alias("url"))
