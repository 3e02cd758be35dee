"""Counts, coverage and roster reports, listings and section maps.

A report over many items is a table of its lines. Nothing gathers all lines of
a group into one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import markdown as M
from corpusloom.functions.text import fixed, name_slug, year_of
from corpusloom.operators.scale import Key, down, up

DASH = "—"


def item_counts(items: DataFrame, by: str = "content_type") -> DataFrame:
    return items.groupBy(by).agg(F.count("*").alias("items"))


def status_counts(results: DataFrame) -> DataFrame:
    """Results per status, plus the ok/failed split; every status is counted."""
    return results.groupBy("status").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status").isin("failed", "error")).alias("failed"),
    )


def pdfs_by_slug(registry: DataFrame) -> DataFrame:
    """Distinct (policy_slug, filename); migrated and canonical entries coincide."""
    return (
        registry.filter("policy_slug <> '' and filename <> ''")
        .select("policy_slug", "filename")
        .distinct()
    )


def policy_coverage_summary(policies: DataFrame) -> DataFrame:
    linked = F.count_if(F.size("pdf_downloads") > 0)
    return policies.agg(F.count("*").alias("pages"), linked.alias("with_pdfs"))


def policy_coverage_report(policies: DataFrame, registry: DataFrame) -> DataFrame:
    """policies(slug, title, pdf_downloads): linked or not; a linked policy has a row for each file."""
    names = pdfs_by_slug(registry).withColumnRenamed("policy_slug", "slug")
    linked = F.coalesce(F.size("pdf_downloads"), F.lit(0)) > 0
    title = F.coalesce("title", "slug")
    # files of policies without links are not listed
    joined = policies.withColumn("_linked", linked).join(
        names.withColumn("_linked", F.lit(True)), ["slug", "_linked"], "left"
    )
    linked = F.col("_linked")
    files = F.when(linked, F.coalesce("filename", F.lit("(unresolved)"))).otherwise(DASH)
    answer = F.when(linked, "yes").otherwise("no")
    return joined.select(
        title.alias("title"),
        "slug",
        answer.alias("linked"),
        files.alias("file"),
        F.concat(
            F.lit("| "), title, F.lit(" | `"), "slug", F.lit("` | "), answer, F.lit(" | "), files,
            F.lit(" |"),
        ).alias("line"),
    )


def governance_report(
    registry: DataFrame, slugs: tuple[str, str] = ("charter", "constitution")
) -> DataFrame:
    first, second = slugs
    label = F.when(
        F.lower("filename").contains(first), first.capitalize()
    ).otherwise(second.capitalize())
    return (
        pdfs_by_slug(registry)
        .filter(F.col("policy_slug").isin(*slugs))
        .select(
            label.alias("document"),
            "filename",
            F.concat(F.lit("| "), label, F.lit(" | `"), "filename", F.lit("` |")).alias("line"),
        )
    )


def quality_report(results: DataFrame) -> DataFrame:
    """One table line and one notes line (null without notes) per document."""
    status = F.when(F.col("passed"), "✅ pass").otherwise("⚠️ fail")
    cells = [
        F.concat(F.lit("`"), "filename", F.lit("`")),
        F.format_number("pymupdf_words", 0),
        F.format_number("markdown_words", 0),
        F.concat(fixed(F.col("word_coverage") * 100, 1), F.lit("%")),
        *[F.col(c).cast("string") for c in ("headings", "table_rows", "bullets")],
        status,
    ]
    notes = F.concat(
        F.lit("- **`"), "filename", F.lit("`**: "), F.array_join("notes", "; ")
    )
    return results.select(
        "filename",
        F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"),
        F.when(F.size("notes") > 0, notes).alias("notes_line"),
    )


# --- roster -----------------------------------------------------------------


def roster_facts(members: DataFrame, order: str) -> DataFrame:
    """One row: total, distinct electorates, leader (one with an electorate first), deputy."""
    who = F.struct("name", "electorate")
    blank = F.coalesce("electorate", F.lit("")) == ""
    leader = F.min_by(
        F.when(F.col("role") == rules.LEADER_ROLE, who),
        F.when(F.col("role") == rules.LEADER_ROLE, F.struct(blank.cast("int"), F.col(order))),
    )
    deputy = F.min_by(
        F.when(F.col("role") == rules.DEPUTY_ROLE, who),
        F.when(F.col("role") == rules.DEPUTY_ROLE, F.col(order)),
    )
    facts = members.agg(
        F.count("*").alias("total"),
        F.count_distinct(F.nullif(F.col("electorate"), F.lit(""))).alias("electorates"),
        leader.alias("l"),
        deputy.alias("d"),
    )
    return facts.select(
        "total",
        "electorates",
        F.col("l.name").alias("leader"),
        F.col("l.electorate").alias("leader_electorate"),
        F.col("d.name").alias("deputy"),
        F.col("d.electorate").alias("deputy_electorate"),
    )


def roster_table(members: DataFrame, host: str, leadership_only: bool = False) -> DataFrame:
    """Roster lines with their sort key; order by `sort_name` when writing."""
    leading = (rules.LEADER_ROLE, rules.DEPUTY_ROLE)
    rows = members.filter(F.col("role").isin(*leading)) if leadership_only else members
    slug = F.coalesce(F.nullif(F.col("slug"), F.lit("")), name_slug(F.col("name")))
    role = F.coalesce(F.nullif(F.col("role"), F.lit("")), F.lit(rules.DEFAULT_ROLE))
    area = F.coalesce(F.nullif(F.col("electorate"), F.lit("")), F.lit(DASH))
    cells = [
        F.concat(F.lit("["), "name", F.lit("]("), slug, F.lit(".md)")),
        role,
        area,
        F.concat(F.lit(f"[{host}]("), "url", F.lit(")")),
    ]
    return rows.select(
        F.lower("name").alias("sort_name"),
        F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"),
    )


# --- media ------------------------------------------------------------------


def year_summary(items: DataFrame, upload_date: str = "upload_date") -> DataFrame:
    """Per year and overall: how many items, and which tabs."""
    per_tab = (
        items.groupBy(year_of(F.col(upload_date)).alias("year"), "tab")
        .agg(F.count("*").alias("c"))
    )
    return (
        per_tab.rollup("year")
        .agg(
            F.sum("c").alias("items"),
            F.array_join(F.sort_array(F.collect_set("tab")), ", ").alias("tabs"),
            F.grouping("year").alias("_t"),
        )
        .select(
            F.when(F.col("_t") == 1, "Total").otherwise(F.col("year")).alias("year"),
            "items",
            "tabs",
        )
    )


# --- status -----------------------------------------------------------------


def dataset_status(items: DataFrame, as_of: str, fresh_days: int = rules.FRESH_DAYS) -> DataFrame:
    """Items, newest `cleaned_at` and freshness per content type and, as TOTAL, of all of them."""
    stamp = F.try_to_timestamp(F.col("last_cleaned_at").cast("string"))
    age_ok = stamp >= F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {fresh_days} days")
    counted = items.rollup("content_type").agg(
        F.count("*").alias("items"),
        F.max("cleaned_at").alias("last_cleaned_at"),
        F.grouping("content_type").alias("_t"),
    )
    return counted.select(
        F.when(F.col("_t") == 1, "TOTAL").otherwise(F.col("content_type")).alias("content_type"),
        "items",
        "last_cleaned_at",
        F.when(age_ok, "fresh").otherwise("stale").alias("freshness"),
    )


# --- listings ---------------------------------------------------------------


def _bold(label: str, name: str) -> Column:
    c = F.col(name)
    return F.when(c != "", F.concat(F.lit(f"**{label}:** "), c)).otherwise("")


def collection_listing(rows: DataFrame, collection: str, *more: str) -> DataFrame:
    """(slug, entry, *more): the listing block of one item, its blank lines included."""
    head = "name" if collection == "team" else "title"
    suffix = ".md" if collection in ("blog", "policies") else ""
    link = F.concat(
        F.lit("## ["), head, F.lit(f"](/{collection}/"), "slug", F.lit(f"{suffix})")
    )
    middle = {
        "blog": lambda: [
            F.when(F.col("author") != "", F.concat(F.lit("By "), "author")).otherwise(""),
            M.summary(F.col("body"), 100),
        ],
        "policies": lambda: [M.summary(F.col("body"), 200)],
        "events": lambda: [
            _bold("When", "time"), _bold("Venue", "venue"), _bold("Address", "address")
        ],
        "team": lambda: [_bold("Role", "role"), _bold("Electorate", "electorate")],
    }[collection]()
    return rows.select(
        "slug", F.concat_ws("\n", link, F.lit(""), *middle, F.lit("")).alias("entry"), *more
    )


def event_list_line() -> Column:
    date = F.coalesce(F.nullif(F.col("date"), F.lit("")), F.lit("TBD"))
    place = F.when(F.col("location") != "", F.concat(F.lit(" · "), "location")).otherwise("")
    return F.concat(date, F.lit(" — "), "title", place)


def collection_order(collection: str) -> list[Key]:
    """Published order of a collection, with the slug as a unique tiebreak."""
    def text(c: str) -> Column:
        return F.collate(F.coalesce(c, F.lit("")), "UNICODE")

    first = {
        "policies": [up(text("title"))],
        "blog": [down(text("date"))],
        "events": [up(text("date"))],
        "team": [up(text("name"))],
        "team-cards": [up(text("role")), up(text("name"))],
    }[collection]
    return [*first, up("slug")]


def section_map(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, items, line): each section's size and one link line per item."""
    out = None
    for name, df in sections.items():
        rows = df.select(
            F.lit(name).alias("section"),
            F.concat(
                F.lit("- ["), "title", F.lit(f"](/{name}/"), "slug", F.lit(".md)")
            ).alias("line"),
        )
        out = rows if out is None else out.unionByName(rows)
    counts = out.groupBy("section").agg(F.count("*").alias("items"))
    # one row per named section: as many as the caller passed
    return out.join(F.broadcast(counts), "section")


def patched_files(docs: DataFrame, text: str, patched: str) -> DataFrame:
    return docs.filter(F.col(patched) != F.col(text))


def patched_report(docs: DataFrame, group: str, text: str, patched: str) -> DataFrame:
    """Changed files per group; the files themselves are `patched_files`."""
    return (
        docs.filter(F.col(patched) != F.col(text))
        .groupBy(group)
        .agg(F.count("*").alias("patch_count"))
    )

