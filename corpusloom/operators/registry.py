"""Download registry, content dedupe, images and their manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.text import (
    blank_to_null,
    drive_file_id,
    filename_from_url,
    filename_stem_slug,
    registry_key,
    slug_from_filename,
    strip,
    year_of,
)
from corpusloom.operators.scale import first_by, lookup_join, numbered
from corpusloom.rules import HS


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def pdf_entries_to_items(
    index: DataFrame, items: DataFrame, files: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(matched, missed) index entries that have a clean item and a source file."""
    kind = F.regexp_replace(basename(F.col("output_file")), r"^pdf-|\.md$", "")
    entries = index.withColumn("slug", F.concat("policy_slug", F.lit("-"), kind))
    cleaned = items.select("slug").distinct().withColumn("has_item", F.lit(True))
    stored = files.select(F.col("filename").alias("source_file")).distinct().withColumn(
        "has_file", F.lit(True)
    )
    flagged = lookup_join(lookup_join(entries, cleaned, ["slug"]), stored, ["source_file"])
    both = F.col("has_item").isNotNull() & F.col("has_file").isNotNull()
    flags = ("has_item", "has_file")
    return flagged.filter(both).drop(*flags), flagged.filter(~both).drop(*flags)


def slug_from_registry(
    files: DataFrame, registry: DataFrame, order: str = "ord", prefixes=rules.FILENAME_PREFIXES
) -> DataFrame:
    """Policy slug of each file: its first registry entry, else derived from the name."""
    known = first_by(
        registry.select(basename(F.col("filename")).alias("filename"), order, "policy_slug"),
        ["filename"], F.col(order),
    ).drop(order)
    joined = lookup_join(files, known, ["filename"])
    derived = slug_from_filename(F.col("filename"), prefixes)
    return joined.withColumn(
        "policy_slug", F.coalesce(blank_to_null(F.col("policy_slug")), derived)
    )


def classify_downloads(links: DataFrame, registry: DataFrame, dry_run: bool = False) -> DataFrame:
    """Outcome of each link: links(ord, policy_slug, url, md5), md5 null when the fetch failed;
    registry(key, filename, md5, ord, present).

    Links are taken in `ord` order: the first fetched link of a key stores it and
    later ones are skipped; content already stored keeps its first file name.
    """
    own = F.when(
        drive_file_id(F.col("url")).isNotNull(),
        F.concat(drive_file_id(F.col("url")), F.lit(".pdf")),
    ).otherwise(filename_from_url(F.col("url")))
    keyed = links.withColumns({"key": registry_key(F.col("url")), "own": own})
    stored = registry.filter("present").select("key", F.col("filename").alias("reg_file"))
    known = lookup_join(keyed, stored, ["key"])
    fresh = known.filter("reg_file is null and md5 is not null")
    first_key = fresh.groupBy("key").agg(
        F.min("ord").alias("first_ord"),
        F.min_by("md5", "ord").alias("first_md5"),
        F.min_by("own", "ord").alias("first_own"),
    )
    ranked = lookup_join(known, first_key, ["key"])
    by_hash = registry.filter("md5 is not null").groupBy(F.col("md5").alias("first_md5")).agg(
        F.min_by("filename", "ord").alias("hash_file")
    )
    first_hash = first_key.groupBy("first_md5").agg(
        F.min("first_ord").alias("hash_ord"), F.min_by("first_own", "first_ord").alias("hash_own")
    )
    facts = first_hash.join(by_hash, "first_md5", "left")
    full = lookup_join(ranked, facts, ["first_md5"])
    earlier = F.when(F.col("hash_ord") < F.col("first_ord"), F.col("hash_own"))
    canonical = F.coalesce("hash_file", earlier)
    drive = drive_file_id(F.col("url")).isNotNull()
    repeat = F.col("ord") > F.col("first_ord")
    status = (
        F.when(F.col("reg_file").isNotNull(), "skipped")
        .when(F.lit(dry_run), "dry_run")
        .when(repeat, "skipped")
        .when(F.col("md5").isNull(), "failed")
        .when(drive & canonical.isNotNull(), "deduplicated")
        .otherwise("downloaded")
    )
    filename = (
        F.when(F.col("reg_file").isNotNull(), F.col("reg_file"))
        .when(F.lit(dry_run), "?")
        .when(repeat, F.coalesce(canonical, "first_own"))
        .when(F.col("md5").isNull(), F.when(drive, "").otherwise(F.col("own")))
        .otherwise(F.coalesce(canonical, "own"))
    )
    return full.select(
        "ord", "policy_slug", "url", filename.alias("filename"), status.alias("status")
    )


def unregistered_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows for files on disk that it lacks: files(filename, size_bytes, md5, mtime)."""
    lacking = files.join(registry.select("filename").distinct(), "filename", "left_anti")
    return lacking.select(
        F.concat(F.lit("_migrated_"), "filename").alias("key"),
        F.lit(None).cast("string").alias("source_url"),
        filename_stem_slug(F.col("filename")).alias("policy_slug"),
        "filename",
        F.col("mtime").alias("downloaded_at"),
        "size_bytes",
        "md5",
    )


def missing_downloads(
    policies: DataFrame, registry: DataFrame, host: str = rules.FILE_HOST
) -> DataFrame:
    """(slug, url) of hosted links of policies without any registered file."""
    have = registry.filter("policy_slug <> '' and filename <> ''").select(
        F.col("policy_slug").alias("slug")
    ).distinct()
    without = policies.join(have, "slug", "left_anti")
    return without.select("slug", F.explode("pdf_downloads").alias("url")).filter(
        F.col("url").contains(host)
    )


def pages_with_pictures(
    images: DataFrame, pages: DataFrame | None, marker: str = "Start of picture text"
) -> DataFrame:
    """Images of pages whose text has a picture marker; None keeps every image."""
    if pages is None:
        return images
    marked = pages.filter(F.col("text").contains(marker)).select("doc", "page").distinct()
    return lookup_join(images, marked, ["doc", "page"], "left_semi")


def dedupe_by_id(items: DataFrame, key: str, order: Column) -> DataFrame:
    """First occurrence of each id."""
    return first_by(items, [key], order)


def enumerate_media(tabs: dict[str, DataFrame]) -> DataFrame:
    """Listings of several tabs as one table; an id keeps its first tab."""
    out = None
    for n, (tab, df) in enumerate(tabs.items()):
        rows = df.withColumns({"tab": F.lit(tab), "_tab": F.lit(n)})
        out = rows if out is None else out.unionByName(rows)
    return dedupe_by_id(out, "id", F.struct("_tab", "ord")).drop("_tab")


def group_by_year(items: DataFrame, upload_date: str = "upload_date") -> DataFrame:
    """Items with their year; a year is a set of rows, never one collected value."""
    return items.withColumn("year", year_of(F.col(upload_date)))


def dedupe_by_content(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Adds md5, canonical (lowest key with the same content) and is_duplicate."""
    hashed = docs.withColumn("md5", F.md5(text))
    canon = hashed.groupBy("md5").agg(F.min(key).alias("canonical"))
    return lookup_join(hashed, canon, ["md5"]).withColumn(
        "is_duplicate", F.col("canonical") != F.col(key)
    )


# --- images -----------------------------------------------------------------


def image_page(filename: Column) -> Column:
    """Page of `img-{page}-{index}.ext`; 0 when the name has another form."""
    parts = F.split(F.regexp_replace(filename, r"\.[^.]*$", ""), "-", -1)
    page = F.try_to_number(F.get(parts, 1), F.lit("9999999999")).cast("int")
    plain = F.when(F.get(parts, 1).rlike(r"^\d{1,9}$"), page)
    return F.when(F.size(parts) >= 3, F.coalesce(plain, F.lit(0))).otherwise(0)


def image_manifest(files: DataFrame) -> DataFrame:
    """(doc, n, page, filename, size_bytes): a document's images by page, then name."""
    paged = files.withColumn("page", image_page(F.col("filename")))
    return numbered(paged, ["doc"], ["page", "filename"]).drop("before")


def changed_manifests(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose ordered image list differs from the stored one."""
    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("doc").agg(
            F.struct(F.count("*"), F.bit_xor(F.xxhash64("n", "filename"))).alias(name)
        )

    both = digest(new, "a").join(digest(stored, "b"), "doc", "left")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("doc")


_BLOCK = (
    r"(?md)^\*\*----- Start of picture text -----\*\*<br>\n"
    r"[^\n]*\*\*----- End of picture text -----\*\*<br>\n"
)


def nth_block_to_nth_image(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """(doc, n, block, filename): picture blocks paired with images by position."""
    blocks = docs.select(
        "doc", F.posexplode(F.regexp_extract_all("md", F.lit(_BLOCK), F.lit(0)))
    ).select("doc", (F.col("pos") + 1).cast("bigint").alias("n"), F.col("col").alias("block"))
    return blocks.join(manifest.select("doc", "n", "filename"), ["doc", "n"], "left")


def next_headings(docs: DataFrame) -> DataFrame:
    """(doc, line_no, heading, next_heading): bold H1/H2 lines and the heading that
    follows them with only blank lines between; null when other text does."""
    bold = rf"^#{{1,2}} \*\*([^*]+)\*\*{HS}*\z"
    numbered_lines = F.transform(
        F.split("md", "\n", -1),
        lambda x, i: F.struct((i + 1).cast("bigint").alias("line_no"), strip(x).alias("line")),
    )
    solid = docs.select("doc", F.filter(numbered_lines, lambda x: x["line"] != "").alias("ls"))
    pairs = solid.select(
        "doc",
        F.inline(
            F.transform(
                "ls",
                lambda x, i: F.struct(
                    x["line_no"].alias("line_no"),
                    x["line"].alias("line"),
                    F.get(F.col("ls"), i + 1)["line"].alias("follow"),
                ),
            )
        ),
    )
    return pairs.filter(F.col("line").rlike(bold)).select(
        "doc",
        "line_no",
        F.regexp_extract("line", bold, 1).alias("heading"),
        F.when(F.col("follow").rlike(bold), F.regexp_extract("follow", bold, 1)).alias(
            "next_heading"
        ),
    )
