"""Scalar text functions: slugs, title case, dates, ages, hashes, escapes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.rules import FILENAME_PREFIXES, PY_WS


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(PY_WS))


def rstrip_long(c: Column) -> Column:
    """`rstrip` for long texts: a trim walks over all of a text, so one that ends in a printable ASCII byte is left alone."""
    def trimmed(x: Column) -> Column:
        last = F.substring(x.cast("binary"), -1, 1)
        plain = last.between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~")))
        return F.when(plain, x).otherwise(rstrip(x))

    return let(c, trimmed)


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(PY_WS))


def sub(c: Column, pattern: str, repl: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(repl))


def quoted(c: Column) -> Column:
    """A column's text as a literal inside a Java pattern."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def unlines(c: Column) -> Column:
    return F.array_join(c, "\n")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`.

    Chained rewrites that mention their input more than once would otherwise
    copy the whole upstream expression at every mention.
    """
    return F.get(F.transform(F.array(value), body), 0)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_nonblank(*cs: Column) -> Column:
    """The `a or b or ''` idiom of string records."""
    return F.coalesce(*[blank_to_null(c) for c in cs], F.lit(""))


def title_slug(c: Column) -> Column:
    kept = F.trim(sub(F.lower(c), r"[^a-z0-9\- ]", ""))
    return F.left(sub(F.replace(kept, F.lit(" "), F.lit("-")), "-{2,}", "-"), F.lit(80))


def doc_type_slug(c: Column) -> Column:
    kept = sub(F.replace(strip(F.lower(c)), F.lit("'"), F.lit("")), r"[^a-z0-9\- ]", "")
    return F.btrim(sub(F.replace(kept, F.lit(" "), F.lit("-")), "-{2,}", "-"), F.lit("-"))


def filename_stem_slug(c: Column, prefixes: tuple[str, ...] = FILENAME_PREFIXES[:1]) -> Column:
    """First `_` part of a file name, lower-case and dashed; no rejection of odd names."""
    name = reduce(lambda x, p: F.replace(x, F.lit(p), F.lit("")), (*prefixes, ".pdf"), c)
    part = F.split(name, "_", -1)[0]
    return F.btrim(F.replace(F.lower(part), F.lit(" "), F.lit("-")), F.lit("-"))


def slug_from_filename(c: Column, prefixes: tuple[str, ...] = FILENAME_PREFIXES) -> Column:
    """As above, but null for ids (over 30 characters) and names without a letter."""
    slug = filename_stem_slug(F.replace(c, F.lit("_migrated_"), F.lit("")), prefixes)
    return F.when((F.length(slug) <= 30) & slug.rlike(r"\p{L}"), slug)


def path_slug(c: Column, prefix: str = "candidate-") -> Column:
    bare = F.btrim(c, F.lit("/"))
    return F.when(bare.startswith(prefix), F.substr(bare, F.lit(len(prefix) + 1))).otherwise(bare)


def name_slug(c: Column) -> Column:
    dashed = F.translate(F.lower(c), " /", "--")
    kept = sub(sub(dashed, "[^a-z0-9-]", ""), "-{2,}", "-")
    return F.left(F.btrim(kept, F.lit("-")), F.lit(60))


def title_case(c: Column) -> Column:
    """Capitalise after every non-letter (initcap only splits on blanks)."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))

    def capital(r: Column) -> Column:
        # upper-casing may give two letters, of which only the first stays upper
        first = F.upper(F.left(r, F.lit(1)))
        rest = F.concat(F.substr(first, F.lit(2)), F.substr(r, F.lit(2)))
        return F.concat(F.left(first, F.lit(1)), F.lower(rest))

    return F.array_join(F.transform(runs, capital), "")


def slug_title(c: Column) -> Column:
    return title_case(F.replace(c, F.lit("-"), F.lit(" ")))


def media_slug(c: Column) -> Column:
    kept = sub(F.lower(c), r"(?U)[^\p{L}\p{N}_\s-]", "")
    return F.left(F.btrim(sub(sub(kept, r"(?U)[\s_]+", "-"), "-+", "-"), F.lit("-")), F.lit(80))


def label_slug(c: Column) -> Column:
    dashed = F.replace(F.lower(c), F.lit(" "), F.lit("-"))
    return F.btrim(sub(dashed, "[^a-z0-9-]", ""), F.lit("-"))


_RFC822 = (
    r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun), "
    r"(\d{1,2} (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) \d{4}) "
    r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d (?:[+-]\d\d:?[0-5]\d|Z)$"
)


def rfc822_date(c: Column) -> Column:
    """Feed date in the feed's own offset; anything else is an empty string."""
    day = F.try_to_date(blank_to_null(F.regexp_extract(c, _RFC822, 1)), "d MMM yyyy")
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def display_date(c: Column) -> Column:
    """`Jun 8, 2026` or `June 8, 2026` as an ISO date, else an empty string."""
    day = F.coalesce(F.try_to_date(c, "MMM d, yyyy"), F.try_to_date(c, "MMMM d, yyyy"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def fixed(c: Column, digits: int) -> Column:
    """`%.{digits}f` of a double from 0 to 100, rounded on its exact binary value.

    Java rounds the shortest decimal form half up, which differs at ties; here
    the fraction becomes an exact integer (times a power of two) first.
    """
    bits, unit = 62, 10**digits
    den = F.lit(2**bits).cast("decimal(20,0)")

    def split(x: Column) -> Column:
        part = (x - F.floor(x)) * F.lit(float(2**bits))
        exact = part.cast("bigint")
        scaled = exact.cast("decimal(20,0)") * F.lit(unit).cast("decimal(6,0)")
        return F.struct(
            F.floor(x).cast("bigint").alias("whole"),
            scaled.alias("scaled"),
            (part != exact.cast("double")).alias("more"),
            F.floor(scaled / den).cast("bigint").alias("q"),
        )

    def text(s: Column) -> Column:
        twice = (s["scaled"] - s["q"].cast("decimal(12,0)") * den) * 2
        tie = F.when(s["more"], 1).otherwise(s["q"] % 2)
        up = F.when(twice > den, 1).when(twice == den, tie).otherwise(0)
        n = s["whole"] * unit + s["q"] + up
        return let(n, lambda v: F.concat(
            F.floor(v / unit).cast("string"), F.lit("."),
            F.lpad((v % unit).cast("string"), digits, "0"),
        ))

    return let(split(c), text)


def format_age(seconds: Column) -> Column:
    s = seconds.cast("bigint")
    hours = F.floor(s / 3600).cast("bigint")
    minutes = F.floor((s % 3600) / 60).cast("bigint")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat(minutes.cast("string"), F.lit("m")))
        .otherwise(F.concat(hours.cast("string"), F.lit("h"), minutes.cast("string"), F.lit("m")))
    )


def video_label(title: Column, duration: Column, tab: Column) -> Column:
    clock = F.format_string(
        "  [%d:%02d]", F.floor(duration / 60).cast("bigint"), (duration % 60).cast("bigint")
    )
    return F.concat(
        title,
        F.when(F.coalesce(duration, F.lit(0)) != 0, clock).otherwise(""),
        F.when(tab == "shorts", " [short]").otherwise(""),
    )


def year_of(upload_date: Column) -> Column:
    return F.when(F.length(upload_date) >= 4, F.left(upload_date, F.lit(4))).otherwise("unknown")


def url_key(url: Column) -> Column:
    return F.left(F.sha2(url, 256), F.lit(16))


def now_iso() -> Column:
    """The time a query starts, in UTC to the second; the same for all its rows."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def is_pdf_bytes(content: Column) -> Column:
    return F.coalesce(F.hex(F.substring(content, 1, 4)) == "25504446", F.lit(False))


def yaml_escape(c: Column) -> Column:
    steps = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"))
    return reduce(lambda x, s: F.replace(x, F.lit(s[0]), F.lit(s[1])), steps, c)


def quote_escape(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit('\\"'))


def canonical_path(url: Column, host: str = r"[^/]+") -> Column:
    """Drop scheme and host (any host unless one is given) and force a leading slash."""
    return let(
        sub(url, rf"^https?://{host}", ""),
        lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)),
    )


def drive_file_id(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, "/file/d/([A-Za-z0-9_-]+)", 1))


def registry_key(url: Column) -> Column:
    return F.coalesce(drive_file_id(url), url)


def filename_from_url(url: Column) -> Column:
    path = sub(sub(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "[?#].*$", "")
    name = first_nonblank(F.element_at(F.split(F.rtrim(path, F.lit("/")), "/", -1), -1))
    named = F.when(name == "", "download.pdf").otherwise(name)
    return F.when(F.lower(named).endswith(".pdf"), named).otherwise(F.concat(named, F.lit(".pdf")))
