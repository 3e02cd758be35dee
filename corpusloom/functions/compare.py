"""Word-level comparison of two extractions of one document."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.markdown import INLINE_GLYPHS, strip_glyphs
from corpusloom.functions.text import let, strip, sub
from corpusloom.rules import WS


def _plain(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if unicodedata.category(ch) != "Mn")


@lru_cache(maxsize=1)
def _latin_table() -> tuple[str, str]:
    """Accented letters below U+0250 that decompose to one ASCII character."""
    pairs = [(chr(n), _plain(chr(n))) for n in range(0xA0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1 and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@lru_cache(maxsize=1)
def _odd_class() -> str:
    """Ranges of characters that need full decomposition.

    Below U+0250 these are the few that become several characters or stay
    outside ASCII; above it everything but dashes, quotes and bullets.
    """
    known = set(_latin_table()[0])
    odd = [n for n in range(0xA0, 0x250) if _plain(chr(n)) != chr(n) and chr(n) not in known]
    plain = {n for n in range(0x2010, 0x2023) if _plain(chr(n)) == chr(n)}
    odd += [n for n in range(0x250, 0x10000) if n not in plain]
    ranges: list[list[int]] = []
    for n in odd:
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    body = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)
    return rf"[{body}\x{{10000}}-\x{{10ffff}}]"


@F.pandas_udf(T.StringType())
def _nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(_plain, na_action="ignore")


def normalise_compare(text: Column) -> Column:
    """Glyph-free text without combining marks.

    Latin text is handled by one `translate`; only rows holding anything else
    reach the Arrow UDF (the others send it a null).
    """
    clean = strip_glyphs(text)
    odd = F.when(clean.rlike(_odd_class()), clean)
    source, target = _latin_table()
    return F.coalesce(_nfkd(odd), F.translate(clean, source, target))


def tokens(normalised: Column) -> Column:
    return F.regexp_extract_all(normalised, F.lit("[A-Za-z0-9]+"), F.lit(0))


@lru_cache(maxsize=1)
def _token_table() -> tuple[str, str]:
    """As `_latin_table`, with characters that never belong to a token as dashes
    and the invisible glyphs dropped."""
    source, target = _latin_table()
    fixed = [chr(n) for n in range(0x80, 0x250) if _plain(chr(n)) == chr(n) and n != 0xAD]
    fixed += [chr(n) for n in range(0x2012, 0x2023) if _plain(chr(n)) == chr(n)] + ["\u20ac"]
    return source + "".join(fixed) + INLINE_GLYPHS, target + "-" * len(fixed)


def with_tokens(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds token arrays: {new column: text column}.

    One `translate` leaves Latin text in plain ASCII, which a length check
    confirms; only rows where it does not are normalised by the Arrow UDF.
    """
    plain = {f"_t_{c}": F.translate(c, *_token_table()) for c in columns.values()}
    flat = df.withColumns(plain)

    def token_text(c: str) -> Column:
        t = F.col(f"_t_{c}")
        odd = F.when(F.octet_length(t) != F.length(t), strip_glyphs(F.col(c)))
        return F.coalesce(_nfkd(odd), t)

    return flat.withColumns(
        {out: tokens(token_text(c)) for out, c in columns.items()}
    ).drop(*plain)


def unique_words(token_array: Column) -> Column:
    return F.array_distinct(F.transform(token_array, F.lower))


def coverage(raw_words: Column, md_words: Column) -> Column:
    """Share of the raw extraction's words that the markdown still has."""
    shared = F.size(F.array_intersect(raw_words, md_words))
    return F.when(F.size(raw_words) == 0, F.lit(0.0)).otherwise(shared / F.size(raw_words))


def headings(md: Column) -> Column:
    return F.regexp_count(md, F.lit(rf"(?md)^#{{1,6}}{WS}"))


def table_rows(md: Column) -> Column:
    return F.regexp_count(md, F.lit(r"(?md)^\|"))


def bullets(md: Column) -> Column:
    return F.regexp_count(md, F.lit("(?md)^- "))


def glyph_artefacts(body: Column) -> Column:
    return F.regexp_count(body, F.lit("[A-Za-z][\\ufffd\\u200b-\\u200f]"))


def render_snippet(md: Column) -> Column:
    """First body line that survives rendering as plain text, without markup."""
    def usable(line: Column) -> Column:
        bare = strip(line)
        return (
            (bare != "")
            & ~bare.rlike(r"^(?:\||!\[|<!--)")
            & ~F.lower(line).contains("picture")
        )

    line = F.get(F.filter(F.split(md, "\n", -1), usable), 0)
    plain = strip(sub(line, "[#*`_]", ""))
    return sub(plain, f"{WS}+", " ")


def snippet_in_render(md: Column, rendered: Column) -> Column:
    """Null when the markdown has no usable line."""
    return let(
        render_snippet(md), lambda s: sub(rendered, f"{WS}+", " ").contains(s)
    )
