"""Record types: clean items, their index, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()
_LIST = T.ArrayType(_S)


def _struct(*fields) -> T.StructType:
    return T.StructType(
        [T.StructField(*f) if isinstance(f, tuple) else T.StructField(f, _S) for f in fields]
    )


INDEX_ENTRY = _struct("slug", "content_type", "source_id", "source_url", "title", "date")
VALIDATION = _struct(
    "filename", ("pymupdf_words", _L), ("markdown_words", _L), ("unique_words_pymupdf", _L),
    ("unique_words_markdown", _L), ("word_coverage", T.DoubleType()), ("headings", _L),
    ("table_rows", _L), ("bullets", _L), ("passed", T.BooleanType()), ("notes", _LIST),
)

PROVENANCE = (
    "slug", "content_type", "source_id", "source_type", "source_url", "ingested_at", "cleaned_at"
)
TYPE_FIELDS = {
    "policy": ("title", "summary", "pdf_urls", "tags"),
    "blog-post": ("title", "date", "author", "excerpt"),
    "event": ("title", "date", "time", "location", "venue", "address", "description",
              "registration_url"),
    "team-member": ("name", "role", "electorate"),
    "party-information": ("title",),
    "pdf-document": ("title", "policy_slug"),
}
LIST_FIELDS = ("pdf_urls", "tags")
_ALL_FIELDS = tuple(dict.fromkeys(f for fs in TYPE_FIELDS.values() for f in fs))
CLEAN_ITEM = _struct(
    *PROVENANCE,
    *[(f, _LIST) if f in LIST_FIELDS else f for f in _ALL_FIELDS],
    "body",
)


# What a policy's PDF file says; `heading` stands before it, or is empty.
SECTION = _struct("slug", "file", "heading", "detail")


def conform(df: DataFrame, schema: T.StructType = CLEAN_ITEM) -> DataFrame:
    """Exactly the schema's columns in order; absent ones are null."""
    def pick(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in df.columns else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select(*[pick(f) for f in schema.fields])
