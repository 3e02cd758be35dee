"""Extraction checks: two extractions of each document compared row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import compare as V
from corpusloom.functions.markdown import clean_pdf_body
from corpusloom.functions.text import fixed


def word_stats(docs: DataFrame, raw: str = "raw_text", md: str = "raw_md") -> DataFrame:
    """Adds token counts, unique counts and coverage. No shuffle: all within the row."""
    tokenised = V.with_tokens(docs, {"_raw": raw, "_md": md})
    unique = tokenised.withColumns(
        {"_ru": V.unique_words(F.col("_raw")), "_mu": V.unique_words(F.col("_md"))}
    )
    return unique.withColumns(
        {
            "pymupdf_words": F.size("_raw").cast("bigint"),
            "markdown_words": F.size("_md").cast("bigint"),
            "unique_words_pymupdf": F.size("_ru").cast("bigint"),
            "unique_words_markdown": F.size("_mu").cast("bigint"),
            "coverage": V.coverage(F.col("_ru"), F.col("_mu")),
        }
    ).drop("_raw", "_md", "_ru", "_mu")


def validate(
    docs: DataFrame,
    threshold: float = rules.COVERAGE_THRESHOLD,
    footers=rules.PAGE_FOOTERS,
) -> DataFrame:
    """docs(filename, raw_text, raw_md) to one validation row per document.

    Coverage is measured on the raw markdown, structure on the cleaned one. A
    document with a missing extraction becomes a failed row, never an error.
    """
    broken = F.col("raw_text").isNull() | F.col("raw_md").isNull()
    stats = word_stats(docs).withColumn("body", clean_pdf_body(F.col("raw_md"), footers))
    counted = stats.withColumns(
        {
            "headings": V.headings(F.col("body")).cast("bigint"),
            "table_rows": V.table_rows(F.col("body")).cast("bigint"),
            "bullets": V.bullets(F.col("body")).cast("bigint"),
            "artefacts": V.glyph_artefacts(F.col("body")),
        }
    )
    low = F.col("coverage") < threshold
    notes = F.array_compact(
        F.array(
            F.when(
                F.col("artefacts") > 0,
                F.format_string("%d font-glyph artefact(s) in body", "artefacts"),
            ),
            F.when(
                low,
                F.concat(
                    F.lit("word coverage "),
                    fixed(F.col("coverage"), 3),
                    F.lit(f" < threshold {threshold}"),
                ),
            ),
            F.when(
                (F.col("pymupdf_words") >= rules.HEADING_MIN_WORDS) & (F.col("headings") == 0),
                F.lit("no headings detected in markdown body"),
            ),
        )
    )
    failed = F.array(F.lit("exception during validation: missing extraction"))
    counts = ("pymupdf_words", "markdown_words", "unique_words_pymupdf",
              "unique_words_markdown", "headings", "table_rows", "bullets")
    zero = F.lit(0).cast("bigint")
    return counted.select(
        "filename",
        *[F.when(broken, zero).otherwise(F.col(c)).alias(c) for c in counts[:4]],
        F.when(broken, 0.0).otherwise(F.round("coverage", 4)).alias("word_coverage"),
        *[F.when(broken, zero).otherwise(F.col(c)).alias(c) for c in counts[4:]],
        (~broken & ~F.coalesce(low, F.lit(True))).alias("passed"),
        F.when(broken, failed).otherwise(notes).alias("notes"),
    )


def validation_summary(
    results: DataFrame, threshold: float = rules.COVERAGE_THRESHOLD
) -> DataFrame:
    passed = F.count_if("passed")
    return results.agg(
        F.lit(threshold).alias("threshold"),
        F.count("*").alias("pdf_count"),
        passed.alias("passed_count"),
        (F.count("*") - passed).alias("failed_count"),
    )


def validation_json(results: DataFrame) -> DataFrame:
    """One JSON object per result; the payload's header is `validation_summary`."""
    return results.select("filename", F.to_json(F.struct(*results.columns)).alias("json"))
