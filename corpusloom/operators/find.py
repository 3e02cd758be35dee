"""Faceted queries over clean items: filter, sort, page, look up."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.operators.reports import collection_order
from corpusloom.operators.scale import Key, down, lookup_join, nth_rows, up


# --- arguments --------------------------------------------------------------


def check_arguments(
    allowed: set[str], given: dict, text: tuple[str, ...] = (), dates: tuple[str, ...] = ()
) -> dict:
    """Trimmed arguments, or a ValueError before any job starts."""
    extra = sorted(set(given) - allowed)
    if extra:
        raise ValueError(f"unknown arguments: {', '.join(extra)}")
    out = {k: v.strip() if isinstance(v, str) else v for k, v in given.items()}
    for k in text:
        v = out.get(k)
        if v is not None and not (isinstance(v, str) and 1 <= len(v) <= 200):
            raise ValueError(f"{k} must have 1 to 200 characters")
    for k in dates:
        if out.get(k) is not None:
            # other ISO spellings compare wrongly as text
            out[k] = dt.date.fromisoformat(out[k]).isoformat()
    limit, offset = out.get("limit"), out.get("offset", 0)
    for k, v in (("limit", limit), ("offset", offset)):
        if v is not None and (isinstance(v, bool) or not isinstance(v, int)):
            raise ValueError(f"{k} must be an integer")
    if limit is not None and not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    if offset < 0:
        raise ValueError("offset must not be negative")
    tags = out.get("tags")
    if tags is not None and not all(isinstance(t, str) for t in tags):
        raise ValueError("tags must be strings")
    return out


def argument_errors(requests: DataFrame) -> DataFrame:
    """The same checks over logged requests (query, limit, offset, date_from, tags): adds `error`, null if fine."""
    query, limit, offset = F.trim("query"), F.col("limit"), F.col("offset")
    date = F.trim("date_from")
    error = (
        F.when(query.isNotNull() & ~F.length(query).between(1, 200), "query must have 1 to 200 characters")
        .when(date.isNotNull() & F.try_to_date(date, "yyyy-MM-dd").isNull(), "date_from must be a date")
        .when(limit.isNotNull() & ~limit.between(1, 100), "limit must be between 1 and 100")
        .when(offset.isNotNull() & (offset < 0), "offset must not be negative")
    )
    return requests.withColumn("error", error)


# --- pages ------------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    """`items` in sort order and a one-row `envelope`."""

    items: DataFrame
    envelope: DataFrame


def paginate(
    rows: DataFrame, order: list[Key], limit: int = 20, offset: int = 0, after: Column | None = None
) -> Page:
    """`order` must end in a unique column.

    A page is found by counts (`nth_rows`), whatever its offset. `after`, a
    condition on the order's columns that names the last row of the page before,
    leaves out the rows up to there.
    """
    items = nth_rows(rows if after is None else rows.filter(after), order, offset, limit)
    end = F.least(F.col("total"), F.lit(offset + limit))
    more = F.col("total") > offset + limit
    envelope = rows.agg(F.count("*").alias("total")).select(
        "total",
        F.greatest(end - offset, F.lit(0)).cast("bigint").alias("count"),
        F.lit(offset).cast("bigint").alias("offset"),
        more.alias("has_more"),
        F.when(more, offset + limit).cast("bigint").alias("next_offset"),
    )
    return Page(items, envelope)


def page_json(page: Page) -> DataFrame:
    """The whole response as one JSON string; a page holds at most 100 items."""
    numbered_items = F.struct(F.monotonically_increasing_id().alias("_n"), F.struct("*").alias("i"))
    items = page.items.select(numbered_items.alias("r")).agg(
        F.transform(F.array_sort(F.collect_list("r")), lambda r: r["i"]).alias("items")
    )
    return page.envelope.select(
        F.to_json(
            F.struct("*", items.scalar().alias("items")), {"ignoreNullFields": "false"}
        ).alias("json")
    )


# --- predicates -------------------------------------------------------------


def _contains(c: Column, needle: str) -> Column:
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lower(F.lit(needle)))


def _mentions(rows: DataFrame, query: str) -> Column:
    hit = F.lit(False)
    for n in (c for c in ("title", "name", "body") if c in rows.columns):
        hit = hit | _contains(F.col(n), query)
    return hit


def _query(rows: DataFrame, query: str | None) -> DataFrame:
    return rows if query is None else rows.filter(_mentions(rows, query))


def _bounds(date_from: str | None, date_to: str | None) -> Column:
    """Inclusive bounds on the ISO date text, in a form the Parquet scan can use.

    A date that parses has exactly the form yyyy-MM-dd, whose text order is its
    date order; callers add that check.
    """
    keep = F.lit(True)
    if date_from is not None:
        keep = keep & (F.col("date") >= F.lit(date_from))
    if date_to is not None:
        keep = keep & (F.col("date") <= F.lit(date_to))
    return keep


def _is_date() -> Column:
    return F.try_to_date(F.col("date"), "yyyy-MM-dd").isNotNull()


def _dates(rows: DataFrame, date_from: str | None, date_to: str | None) -> DataFrame:
    if date_from is None and date_to is None:
        return rows
    return rows.filter(_bounds(date_from, date_to) & _is_date())


def _of_type(items: DataFrame, content_type: str) -> DataFrame:
    """Items of one content type; a literal predicate, so partitions are pruned."""
    return items.filter(F.col("content_type") == content_type)


def _searched(items, content_type: str, query: str | None, also: DataFrame | None = None) -> DataFrame:
    """Items of a type among which a text is looked for: of a store with an index the candidates, else all."""
    if isinstance(items, DataFrame):
        return _of_type(items, content_type)
    if query is None or items.index is None:
        return _of_type(items.items, content_type)
    return items.index.items_with(query, content_type, also)


# The searches take a frame of items or a store (`read_store`), whose index they use.


def matching_events(items, as_of: str, **arguments) -> DataFrame:
    """Events that pass the filters. A date that does not parse only passes when past
    events and a date bound are both asked for, as it can be on neither side of one."""
    a = check_arguments(
        {"query", "date_from", "date_to", "location", "venue", "include_past", "limit", "offset"},
        arguments, ("query", "location", "venue"), ("date_from", "date_to"),
    )
    rows = _query(_searched(items, "event", a.get("query")), a.get("query"))
    past = bool(a.get("include_past", False))
    bounds = _bounds(a.get("date_from"), a.get("date_to"))
    if past and (a.get("date_from") is not None or a.get("date_to") is not None):
        rows = rows.filter(F.coalesce(~_is_date(), F.lit(True)) | bounds)
    else:
        upcoming = F.lit(True) if past else _bounds(as_of, None)
        rows = rows.filter(bounds & upcoming & _is_date())
    if a.get("location") is not None:
        rows = rows.filter(
            _contains(F.col("location"), a["location"]) | _contains(F.col("address"), a["location"])
        )
    if a.get("venue") is not None:
        rows = rows.filter(_contains(F.col("venue"), a["venue"]))
    return rows


def find_events(items, as_of: str, **arguments) -> Page:
    rows = matching_events(items, as_of, **arguments).select(
        "slug", "content_type", "title", "date", "time", "location", "venue", "address",
        "registration_url", "source_url",
    )
    order = [up("date"), up("slug")]
    return paginate(rows, order, arguments.get("limit", 20), arguments.get("offset", 0))


def find_members(items, **arguments) -> Page:
    a = check_arguments(
        {"query", "role", "electorate", "limit", "offset"}, arguments,
        ("query", "role", "electorate"),
    )
    rows = _query(_searched(items, "team-member", a.get("query")), a.get("query"))
    for k in ("role", "electorate"):
        if a.get(k) is not None:
            rows = rows.filter(F.lower(k) == F.lower(F.lit(a[k])))
    rows = rows.select(
        "slug", "content_type", F.col("name").alias("title"), "name", "role", "electorate",
        "source_url",
    )
    order = [up("role"), up("name"), up("slug")]
    return paginate(rows, order, a.get("limit", 50), a.get("offset", 0))


def linked_pdfs(items: DataFrame) -> DataFrame:
    """(slug, pdf_slug): pdf-document items of each policy."""
    return _of_type(items, "pdf-document").select(
        F.col("policy_slug").alias("slug"), F.col("slug").alias("pdf_slug")
    )


def policy_pdf_slugs(policies: DataFrame, pdfs: DataFrame) -> DataFrame:
    """(slug, pdf_slug): a row for each pdf of a policy, or one with a null."""
    return policies.select("slug").join(pdfs, "slug", "left")


def has_pdf(policies: DataFrame, pdfs: DataFrame, wanted: bool) -> DataFrame:
    how = "left_semi" if wanted else "left_anti"
    return policies.join(pdfs.select("slug").distinct(), "slug", how)


def find_policies(items, sections: DataFrame | None = None, **arguments) -> Page:
    """Policies by text, tags and pdfs; the text is looked for in `sections` (slug, detail) as well.

    A text needs them, since a policy's PDF files say most of what it holds: a
    store (`read_store`) brings its own, and a frame of items comes with them, an
    empty frame if there are none.
    `pdf_slugs` is filled for the page's items only, after the top-k.
    """
    a = check_arguments(
        {"query", "tags", "has_pdf", "limit", "offset"}, arguments, ("query",)
    )
    query, told = a.get("query"), None
    if query is not None:
        if sections is None and isinstance(items, DataFrame):
            raise ValueError("a text is looked for in the sections of PDF files too: give a store or sections")
        if sections is None:
            sections = items.sections if items.index is None else items.index.sections_with(query)
        told = sections.filter(_contains(F.col("detail"), query)).select("slug").distinct()
    rows = _searched(items, "policy", query, told)
    items = items if isinstance(items, DataFrame) else items.items
    for tag in a.get("tags") or []:
        lowered = F.transform("tags", lambda t: F.lower(t))
        rows = rows.filter(F.array_contains(lowered, F.lower(F.lit(tag))))
    pdfs = linked_pdfs(items)
    if a.get("has_pdf") is not None:
        rows = has_pdf(rows, pdfs, a["has_pdf"])
    if told is not None:
        marked = rows.join(told.withColumn("_told", F.lit(True)), "slug", "left")
        own = F.coalesce(_mentions(rows, query), F.lit(False))
        rows = marked.filter(own | F.coalesce("_told", F.lit(False)))
    rows = rows.select("slug", "content_type", "title", "summary", "tags", "source_url")
    order = [up("title"), up("slug")]
    page = paginate(rows, order, a.get("limit", 20), a.get("offset", 0))
    # at most 100 slugs
    lists = pdfs.join(F.broadcast(page.items.select("slug")), "slug", "left_semi").groupBy("slug").agg(
        F.sort_array(F.collect_list("pdf_slug")).alias("pdf_slugs")
    )
    empty = F.array().cast("array<string>")
    items_with = page.items.join(lists, "slug", "left").withColumn(
        "pdf_slugs", F.coalesce("pdf_slugs", empty)
    ).orderBy(*[k.sort() for k in order])
    return Page(items_with, page.envelope)


def find_blog_posts(items, **arguments) -> Page:
    a = check_arguments(
        {"query", "date_from", "date_to", "limit", "offset"}, arguments, ("query",),
        ("date_from", "date_to"),
    )
    rows = _dates(
        _query(_searched(items, "blog-post", a.get("query")), a.get("query")), a.get("date_from"), a.get("date_to")
    ).select("slug", "content_type", "title", "date", "author", "excerpt", "source_url")
    order = [down("date"), up("slug")]
    return paginate(rows, order, a.get("limit", 20), a.get("offset", 0))


def get_item(items: DataFrame, content_type: str, slug: str) -> DataFrame:
    """One item; both filters are literals and reach the scan."""
    if content_type not in rules.CONTENT_TYPES:
        raise ValueError(f"invalid content type: {content_type}")
    check_arguments({"slug"}, {"slug": slug}, ("slug",))
    return items.filter((F.col("content_type") == content_type) & (F.col("slug") == slug))


def lookup_items(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Batch lookup: requests(content_type, slug) with the title or an error as data."""
    known = items.select(
        "content_type", "slug", F.coalesce("title", "name").alias("title")
    )
    joined = lookup_join(
        requests, known.withColumn("found", F.lit(True)), ["content_type", "slug"]
    )
    valid = F.col("content_type").isin(*rules.CONTENT_TYPES)
    error = F.when(~valid, "invalid_content_type").when(F.col("found").isNull(), "not_found")
    return joined.select("content_type", "slug", "title", error.alias("error"))


def home_topk(
    posts: DataFrame, events: DataFrame, members: DataFrame, sizes=(5, 5, 8)
) -> DataFrame:
    """(block, slug): newest posts, earliest events, members by role."""
    team_order = [up(F.coalesce("role", F.lit(""))), up("slug")]
    blocks = (
        ("posts", posts, collection_order("blog"), sizes[0]),
        ("events", events, collection_order("events"), sizes[1]),
        ("team", members, team_order, sizes[2]),
    )
    out = None
    for name, df, order, k in blocks:
        top = df.orderBy(*[o.sort() for o in order]).limit(k).select(F.lit(name).alias("block"), "slug")
        out = top if out is None else out.unionByName(top)
    return out
