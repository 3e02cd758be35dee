"""Raw markdown to clean items: six typed projections, joins, merge upsert, index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules, schemas
from corpusloom.functions import markdown as M
from corpusloom.functions.text import first_nonblank, rstrip, slug_title, strip
from corpusloom.operators.scale import first_by, split_by_bits


def _provenance(content_type: str, url: Column, ingested: Column, cleaned_at: str) -> list[Column]:
    return [
        F.col("slug"),
        F.lit(content_type).alias("content_type"),
        F.lit(rules.SOURCE_ID).alias("source_id"),
        F.lit(rules.SOURCE_TYPE).alias("source_type"),
        url.alias("source_url"),
        ingested.alias("ingested_at"),
        F.lit(cleaned_at).alias("cleaned_at"),
    ]


def _or_blank(m: Column, key: str) -> Column:
    return F.coalesce(M.field(m, key), F.lit(""))


def _single(body: Column) -> list[Column]:
    return [body.alias("body")]


def latest_index(index: DataFrame, order: str = "ord") -> DataFrame:
    """One index entry per slug; the last entry of a slug wins."""
    return first_by(index, ["slug"], F.col(order), last=True).drop(order)


def policy_with_index(raw: DataFrame, index: DataFrame, order: str = "ord") -> DataFrame:
    """Policy files with their structured metadata. Slugs are unique on both sides."""
    entry = latest_index(index, order).select(
        "slug",
        F.col("title").alias("idx_title"),
        F.col("url").alias("idx_url"),
        F.col("scraped_at").alias("idx_scraped"),
        F.col("pdf_downloads").alias("idx_pdfs"),
    )
    return raw.join(entry, "slug", "left")


def pdf_sections(pdfs: DataFrame) -> DataFrame:
    """(slug, file, detail): a cleaned PDF body a row; a policy's sections follow each other by file."""
    return pdfs.select(
        F.col("policy_slug").alias("slug"),
        "file",
        strip(M.strip_pdf_metadata_table(F.col("raw"))).alias("detail"),
    ).filter("detail <> ''")


def policy_sections(pdfs: DataFrame, raw: DataFrame) -> DataFrame:
    """(slug, file, heading, detail): `pdf_sections` as stored and published.

    The first section of a policy that has a page carries the heading that parts
    it from the page's text; a policy known from PDF text alone needs none.
    """
    sections = pdf_sections(pdfs)
    first = sections.join(raw.select("slug"), "slug", "left_semi").groupBy("slug").agg(F.min("file").alias("_first"))
    near, rest = split_by_bits(sections, ["slug", "file"], first.select("slug", F.col("_first").alias("file")))
    heading = F.when(F.col("file") == F.col("_first"), rules.DETAIL_HEADING).otherwise("")
    headed = near.join(first, "slug", "left").select("slug", "file", heading.alias("heading"), "detail")
    return headed.unionByName(rest.select("slug", "file", F.lit("").alias("heading"), "detail"))


def pdf_only_slugs(pdfs: DataFrame, raw: DataFrame) -> DataFrame:
    """Policies known only from PDF text."""
    slugs = pdfs.select(F.col("policy_slug").alias("slug")).distinct()
    return slugs.join(raw.select("slug"), "slug", "left_anti")


def policy_with_pdf_text(items: DataFrame, sections: DataFrame) -> DataFrame:
    """Policies beside their PDF detail: a row for each file, or one without a file."""
    return items.join(sections, "slug", "left")


def clean_policies(
    raw: DataFrame, index: DataFrame, pdfs: DataFrame, cleaned_at: str
) -> DataFrame:
    """raw(slug, raw), index(slug, title, url, scraped_at, pdf_downloads, ord),
    pdfs(policy_slug, file, raw) to policy items, one a slug.

    Slugs with PDF text but no page become items with an empty body. The PDF
    text itself is in `policy_sections`, a row for each file, to be stored,
    published and searched beside the items.
    """
    only = pdf_only_slugs(pdfs, raw).withColumn("raw", F.lit(None).cast("string"))
    rows = policy_with_index(raw.select("slug", "raw").unionByName(only), index)
    paged = F.col("raw").isNotNull()
    heading = F.when(paged, M.h1_title(F.col("raw"))).otherwise(F.col("idx_title"))
    named = rows.withColumns(
        {
            "meta": M.blockquote_meta(F.col("raw")),
            "title": first_nonblank(heading, slug_title(F.col("slug"))),
        }
    )
    none = F.array().cast("array<string>")
    return named.select(
        *_provenance(
            "policy",
            first_nonblank(M.field(F.col("meta"), "URL"), F.col("idx_url")),
            first_nonblank(M.field(F.col("meta"), "Scraped"), F.col("idx_scraped")),
            cleaned_at,
        ),
        "title",
        F.lit("").alias("summary"),
        F.when(paged, F.coalesce("idx_pdfs", none)).otherwise(none).alias("pdf_urls"),
        none.alias("tags"),
        *_single(F.coalesce(M.clean_body(F.col("raw"), F.col("title")), F.lit(""))),
    )


def clean_blog_posts(raw: DataFrame, cleaned_at: str) -> DataFrame:
    src = raw.withColumn("meta", M.metadata_fields(F.col("raw")))
    m = F.col("meta")
    title = F.coalesce(M.field(m, "Title"), F.col("slug"))
    return src.select(
        *_provenance("blog-post", _or_blank(m, "URL"), _or_blank(m, "Scraped"), cleaned_at),
        title.alias("title"),
        _or_blank(m, "Date").alias("date"),
        _or_blank(m, "Author").alias("author"),
        F.lit("").alias("excerpt"),
        *_single(
            M.clean_body(M.without_metadata_fields(F.col("raw")), title, strip_footer=False)
        ),
    )


def clean_events(raw: DataFrame, cleaned_at: str, names=rules.META_FIELDS) -> DataFrame:
    src = raw.withColumn("meta", M.metadata_fields(F.col("raw"), names))
    m = F.col("meta")
    title = F.coalesce(M.field(m, "Title"), F.col("slug"))
    return src.select(
        *_provenance("event", _or_blank(m, "URL"), _or_blank(m, "Scraped"), cleaned_at),
        title.alias("title"),
        _or_blank(m, "Date").alias("date"),
        F.coalesce(M.field(m, "When"), M.field(m, "Time"), F.lit("")).alias("time"),
        _or_blank(m, "Location").alias("location"),
        _or_blank(m, "Venue").alias("venue"),
        _or_blank(m, "Address").alias("address"),
        F.lit("").alias("description"),
        F.lit("").alias("registration_url"),
        *_single(
            M.clean_body(
                M.without_metadata_fields(F.col("raw"), names), title,
                strip_footer=False, strip_media_contact=False,
            )
        ),
    )


def clean_team(raw: DataFrame, cleaned_at: str, generated: tuple[str, ...] = ("team",)):
    """Member items; generated roster pages are not members."""
    src = raw.filter(~F.col("slug").isin(*generated)).withColumns(
        {"meta": M.metadata_fields(F.col("raw")), "quote": M.blockquote_meta(F.col("raw"))}
    )
    m, q = F.col("meta"), F.col("quote")
    name = F.coalesce(
        F.nullif(M.h1_title(F.col("raw")), F.lit("")), M.field(m, "Title"),
        slug_title(F.col("slug")),
    )
    return src.select(
        *_provenance(
            "team-member",
            first_nonblank(M.field(m, "URL"), M.field(q, "URL")),
            first_nonblank(M.field(m, "Scraped"), M.field(q, "Scraped")),
            cleaned_at,
        ),
        name.alias("name"),
        _or_blank(m, "Role").alias("role"),
        _or_blank(m, "Electorate").alias("electorate"),
        *_single(M.clean_body(M.without_metadata_fields(F.col("raw")), name, strip_footer=False)),
    )


def _headed(raw: DataFrame, content_type: str, cleaned_at: str, extra: list[Column], **flags):
    src = raw.withColumns(
        {
            "meta": M.blockquote_meta(F.col("raw")),
            "title": first_nonblank(M.h1_title(F.col("raw")), slug_title(F.col("slug"))),
        }
    )
    m = F.col("meta")
    return src.select(
        *_provenance(content_type, _or_blank(m, "URL"), _or_blank(m, "Scraped"), cleaned_at),
        "title",
        *extra,
        *_single(M.clean_body(F.col("raw"), F.col("title"), **flags)),
    )


def clean_party_info(raw: DataFrame, cleaned_at: str) -> DataFrame:
    return _headed(raw, "party-information", cleaned_at, [], strip_media_contact=False)


def clean_news(raw: DataFrame, cleaned_at: str) -> DataFrame:
    """News items are blog posts without a date or author."""
    blanks = [F.lit("").alias(c) for c in ("date", "author", "excerpt")]
    return _headed(raw, "blog-post", cleaned_at, blanks, strip_footer=False)


def clean_pdf_documents(
    pdfs: DataFrame, cleaned_at: str, policy_slug: str | None = None
) -> DataFrame:
    """pdfs(policy_slug, file = `pdf-{type}.md`, raw) to items `{policy}-{type}`."""
    rows = pdfs if policy_slug is None else pdfs.filter(F.col("policy_slug") == policy_slug)
    kind = F.regexp_replace("file", r"^pdf-|\.md$", "")
    raw = F.col("raw")
    src = rows.withColumns(
        {
            "kind": kind,
            "doc_type": F.coalesce(M.pdf_table_field(raw, "Document Type"), kind),
            "base": F.coalesce(
                M.pdf_table_field(raw, "Policy"), slug_title(F.col("policy_slug"))
            ),
        }
    ).withColumn("slug", F.concat("policy_slug", F.lit("-"), "kind"))
    typed = F.concat("base", F.lit(" — "), "doc_type")
    return src.select(
        *_provenance(
            "pdf-document",
            F.lit(""),
            F.coalesce(M.pdf_table_field(raw, "Downloaded"), F.lit(cleaned_at)),
            cleaned_at,
        ),
        F.when(F.col("doc_type") != "", typed).otherwise(F.col("base")).alias("title"),
        "policy_slug",
        *_single(M.strip_pdf_metadata_table(raw)),
    )


def all_items(*parts: DataFrame) -> DataFrame:
    """Typed outputs as one table with the superset schema."""
    out = schemas.conform(parts[0])
    for p in parts[1:]:
        out = out.unionByName(schemas.conform(p))
    return out


def merge_meta(
    old: DataFrame, new: DataFrame, keys: list[str], extra: str | None = None
) -> DataFrame:
    """Upsert by unique key: new values win, nulls included; old-only rows, columns and map keys stay."""
    columns = list(dict.fromkeys([*old.columns, *new.columns]))
    left = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_o"))
    right = new.select(
        *keys, F.struct(F.lit(True).alias("_new"), *[c for c in new.columns if c not in keys]).alias("_n")
    )
    matched = F.col("_n._new").isNotNull()

    def pick(c: str) -> Column:
        sides = [f"_n.{c}"] * (c in new.columns) + [f"_o.{c}"] * (c in old.columns)
        if c == extra and len(sides) == 2:
            n, o = F.col(sides[0]), F.col(sides[1])
            kept = F.map_filter(o, lambda k, _: ~F.map_contains_key(n, k))
            return F.coalesce(F.map_concat(kept, n), n, o).alias(c)
        if len(sides) == 2:
            return F.when(matched, F.col(sides[0])).otherwise(F.col(sides[1])).alias(c)
        return F.col(sides[0]).alias(c)

    joined = left.join(right, keys, "full_outer")
    return joined.select(*[F.col(c) if c in keys else pick(c) for c in columns])


def clean_index(items: DataFrame) -> DataFrame:
    """Flat catalogue entries; members are listed by name."""
    named = [c for c in ("title", "name") if c in items.columns]
    dated = [F.col("date")] if "date" in items.columns else []
    return items.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in
          ("slug", "content_type", "source_id", "source_url")],
        F.coalesce(*named, F.lit("")).alias("title"),
        F.coalesce(*dated, F.lit("")).alias("date"),
    )


def item_frontmatter(content_type: str) -> Column:
    names = [*schemas.PROVENANCE, *schemas.TYPE_FIELDS[content_type]]
    return M.frontmatter([(n, F.col(n)) for n in names], schemas.LIST_FIELDS)


def rendered_md(content_type: str) -> Column:
    """Stored markdown of an item: frontmatter, then the body."""
    body = F.ltrim(F.col("body"), F.lit("\n"))
    return F.concat(item_frontmatter(content_type), F.lit("\n"), body)


COLLECTIONS = {
    "policies": "policy",
    "blog": "blog-post",
    "events": "event",
    "team": "team-member",
    "party-info": "party-information",
}


def site_table(items: DataFrame, collection: str) -> DataFrame:
    """(slug, md) of one published collection."""
    rows = items.filter(F.col("content_type") == COLLECTIONS[collection])
    body = F.ltrim(F.col("body"), F.lit("\n"))
    page = F.concat(M.site_frontmatter(collection), F.lit("\n"), body)
    return rows.select("slug", M.collapse_blank_runs(page).alias("md"))


def section_table(sections: DataFrame) -> DataFrame:
    """(slug, file, md): what follows a policy's page, a row for each file; a policy's rows follow each other by file."""
    head = F.when(F.coalesce("heading", F.lit("")) != "", F.concat("heading", F.lit("\n\n"))).otherwise("")
    return sections.select("slug", "file", M.collapse_blank_runs(F.concat(head, "detail")).alias("md"))


def split_valid(rows: DataFrame, collection: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a collection's required fields must be present."""
    head = "name" if collection == "team" else "title"
    ok = F.col(head).isNotNull() & F.col("slug").isNotNull()
    return rows.filter(ok), rows.filter(~ok)


def category_select(df: DataFrame, column: str, wanted: list[str], known: list[str]) -> DataFrame:
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"unknown targets: {', '.join(unknown)}")
    return df.filter(F.col(column).isin(*wanted))
