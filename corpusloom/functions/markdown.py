"""Markdown cleaning as Column -> Column rewrites.

Patterns carry (?d) so that only a line feed ends a line. Line rules work on
`split(body, '\\n')` inside the row, so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.text import (
    blank_to_null,
    let,
    lines,
    lstrip,
    quote_escape,
    quoted,
    rstrip,
    rstrip_long,
    slug_title,
    strip,
    sub,
    title_case,
    unlines,
    yaml_escape,
)
from corpusloom.rules import HS, WS


def where_held(body: Column, texts: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """`change` for bodies that hold one of `texts`, without which it would change nothing.

    A pattern needs the body decoded and looks at every character; a plain
    search does neither.
    """
    def changed(b: Column) -> Column:
        held = reduce(lambda x, y: x | y, [b.contains(t) for t in texts])
        return F.when(held, change(b)).otherwise(b)

    return let(body, changed)


_CONTENTS = rf"(?d)^((?s:.*?))## \*\*Contents\*\*{WS}*\n(?:|(?s:.*?)\n)(?=\n## |\z)"


def strip_contents_section(body: Column) -> tuple[Column, Column]:
    """(body without its first contents section, whether one was there)."""
    return F.regexp_replace(body, _CONTENTS, "$1"), body.rlike(_CONTENTS)


def strip_metadata_blockquote(body: Column) -> Column:
    meta = rf"(?d)^>{WS}*\*\*(?:{'|'.join(rules.QUOTE_FIELDS)})\*\*:"

    def kept(b: Column) -> Column:
        rest = unlines(F.filter(lines(b), lambda x: ~(x.startswith(">") & x.rlike(meta))))
        return F.when(b.contains(">"), rest).otherwise(b)

    def led(b: Column) -> Column:
        return F.when(lstrip(b) != b, sub(b, rf"^(?:{WS}+\z|{WS}*\n)", "")).otherwise(b)

    return let(let(body, kept), led)


def collapse_blank_runs(body: Column) -> Column:
    return where_held(body, ("\n\n\n",), lambda b: sub(b, r"\n{3,}", "\n\n"))


def strip_image_lines(body: Column) -> Column:
    image = (
        rf"(?d)^(?:\[?!\[.*?\]\(.*?\)\]?\(.*?\)?|!\[.*?\]\(.*?\)){WS}*\z"
    )

    def kept(b: Column) -> Column:
        rest = unlines(
            F.filter(lines(b), lambda x: ~(x.contains("![") & strip(x).rlike(image)))
        )
        return F.when(b.contains("!["), rest).otherwise(b)

    return collapse_blank_runs(let(body, kept))


def cut_at(body: Column, pattern: str) -> Column:
    """Everything before the first match."""
    return sub(body, rf"(?:{pattern})(?s:.*)\z", "")


def strip_footer_sections(body: Column, markers=rules.FOOTER_MARKERS) -> Column:
    return rstrip_long(cut_at(body, "|".join(markers)))


def strip_duplicate_h1(body: Column, title: Column) -> Column:
    pattern = F.concat(
        F.lit(rf"(?d)^(?:#{WS}+"), quoted(strip(title)), F.lit(rf"{WS}*\n)+")
    )

    def cut(b: Column) -> Column:
        # the pattern is compiled per title, so only where it can match
        return F.when(b.startswith("#"), F.regexp_replace(b, pattern, F.lit(""))).otherwise(b)

    return F.ltrim(let(body, cut), F.lit("\n"))


def remove_close_carousel(body: Column) -> Column:
    cut = where_held(body, ("(X)", "(x)"), lambda b: cut_at(b, rf"(?i)CLOSE{WS}*\(X\)"))
    pager = rf"Previous{WS}*\n{WS}*Next{WS}*\z"
    return rstrip_long(where_held(cut, ("Previous",), lambda b: sub(b, pager, "")))


def remove_media_contact(body: Column) -> Column:
    contact = rf"#####{WS}*Media Contact"
    return rstrip_long(where_held(body, ("Media Contact",), lambda b: cut_at(b, contact)))


def clean_body(
    body: Column,
    title: Column | None = None,
    strip_footer: bool = True,
    strip_media_contact: bool = True,
) -> Column:
    steps = []
    if strip_footer:
        steps.append(strip_footer_sections)
    steps += [strip_metadata_blockquote, strip_image_lines, remove_close_carousel]
    if strip_media_contact:
        steps.append(remove_media_contact)
    if title is not None:
        steps.append(
            lambda b: let(
                b, lambda x: F.when(title == "", x).otherwise(strip_duplicate_h1(x, title))
            )
        )
    steps.append(collapse_blank_runs)
    return reduce(lambda b, step: step(b), steps, body)


# --- metadata ---------------------------------------------------------------


def _is_field(names) -> Callable[[Column], Column]:
    """Whether a line is a field: stripped it has a value, or unstripped it has anything."""
    key = rf"\*\*(?:{'|'.join(names)})\*\*:"
    pattern = rf"(?d)^(?:{key}.|{WS}*{key}.*[^{WS[1:-1]}])"
    return lambda x: x.contains("**:") & x.rlike(pattern)


def _at_last_field(body: Column, use: Callable[[Column, Column], Column]) -> Column:
    """`use(head, rest)`: the lines up to the last with a `**:`, and what follows from a line feed on.

    All fields stand in the head, so the rest, mostly the longer part, needn't be cut into lines.
    """
    def size(b: Column) -> Column:
        tail = let(
            F.substring_index(b, "**:", -1),
            lambda t: F.octet_length(t) - F.octet_length(F.substring_index(t, "\n", 1)),
        )
        return F.when(b.contains("**:"), F.octet_length(b) - tail).otherwise(0)

    def parted(b: Column) -> Column:
        raw = b.cast("binary")  # is cut without counting characters
        return let(size(b), lambda n: use(
            F.substr(raw, F.lit(1), n).cast("string"), F.substr(raw, n + 1, F.octet_length(b)).cast("string"),
        ))

    return let(body, parted)


def metadata_fields(body: Column, names=rules.META_FIELDS) -> Column:
    """`**Key**: Value` lines as map<string,string>; the last line of a key wins."""
    def pair(line: Column) -> Column:
        key = F.substring_index(F.substring_index(line, "**:", 1), "**", -1)
        value = strip(F.substr(line, F.instr(line, "**:") + F.lit(3)))
        return F.struct(key.alias("k"), value.alias("v"))

    return _at_last_field(
        body, lambda head, _: _last_wins(F.transform(F.filter(lines(head), _is_field(names)), pair))
    )


def _last_wins(pairs: Column) -> Column:
    """Entries as a map; of a repeated key the last entry stays."""
    def build(ps: Column) -> Column:
        def collapsed(keys: Column) -> Column:
            values = F.transform(
                F.array_distinct(keys),
                lambda k: F.element_at(F.filter(ps, lambda p: p["k"] == k), -1)["v"],
            )
            plain = F.size(F.array_distinct(keys)) == F.size(keys)
            return F.when(plain, F.map_from_entries(ps)).otherwise(
                F.map_from_arrays(F.array_distinct(keys), values)
            )

        return let(F.transform(ps, lambda p: p["k"]), collapsed)

    return let(pairs, build)


def without_metadata_fields(body: Column, names=rules.META_FIELDS) -> Column:
    is_field = _is_field(names)

    def without(head: Column, rest: Column) -> Column:
        def joined(kept: Column) -> Column:
            return F.when(F.size(kept) > 0, F.concat(unlines(kept), rest)).otherwise(F.substr(rest, F.lit(2)))

        return let(F.filter(lines(head), lambda x: ~is_field(x)), joined)

    return _at_last_field(body, without)


def blockquote_meta(body: Column, names=rules.QUOTE_FIELDS) -> Column:
    pattern = rf"(?d)^>{WS}*\*\*({'|'.join(names)})\*\*:{WS}*(.+)\z"
    quoted_lines = F.filter(lines(body), lambda x: x.contains(">"))
    pairs = F.transform(
        F.filter(F.transform(quoted_lines, strip), lambda x: x.rlike(pattern)),
        lambda x: F.struct(
            F.regexp_extract(x, pattern, 1).alias("k"),
            strip(F.regexp_extract(x, pattern, 2)).alias("v"),
        ),
    )
    return _last_wins(pairs)


def field(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def h1_title(body: Column) -> Column:
    return strip(F.regexp_extract(body, rf"(?md)^#{HS}+(.+)$", 1))


_ROW = rf"(?d)^\|{WS}*(.+?){WS}*\|{WS}*(.+?){WS}*\|\z"


def pdf_table_meta(body: Column) -> Column:
    """Two-part table rows of the whole body as a map; the last row of a key wins."""
    pairs = F.transform(
        F.filter(lines(body), lambda x: x.startswith("|") & x.rlike(_ROW)),
        lambda x: F.struct(
            F.regexp_extract(x, _ROW, 1).alias("k"),
            strip(F.btrim(F.regexp_extract(x, _ROW, 2), F.lit("`"))).alias("v"),
        ),
    )
    return _last_wins(F.filter(pairs, lambda p: ~p["k"].isin(*rules.PDF_TABLE_SKIP)))


def pdf_table_field(body: Column, key: str) -> Column:
    """One key of `pdf_table_meta` without building the map; null when absent."""
    row = rf"(?d)^\|{WS}*\Q{key}\E{WS}*\|{WS}*(.+?){WS}*\|\z"
    hit = F.try_element_at(F.filter(lines(body), lambda x: x.startswith("|") & x.rlike(row)), F.lit(-1))
    return strip(F.btrim(F.regexp_extract(hit, row, 1), F.lit("`")))


def strip_pdf_metadata_table(body: Column) -> Column:
    out = sub(body, r"(?d)^# .+?\n(?:\|.*?\|.*?\n)++\n*", "")
    out = sub(out, rf"(?md)^\*\*.+?\*\*{WS}*$", "")
    out = sub(out, r"(?md)^#[^#].+$", "")

    def without_contents(x: Column) -> Column:
        cut, had = strip_contents_section(x)
        return F.when(had, F.concat(F.lit(rules.CONTENTS_COMMENT), cut)).otherwise(x)

    return let(F.ltrim(out, F.lit("\n")), without_contents)


# --- frontmatter ------------------------------------------------------------


def frontmatter(fields: list[tuple[str, Column]], lists: tuple[str, ...] = ()) -> Column:
    """YAML block; null, empty and [] values are left out, `lists` name array fields."""
    rows = []
    for name, c in fields:
        if name in lists:
            items = F.array_join(
                F.transform(c, lambda v: F.concat(F.lit('"'), yaml_escape(v), F.lit('"'))), ", "
            )
            rows.append(F.when(F.size(c) > 0, F.concat(F.lit(f"{name}: ["), items, F.lit("]"))))
        else:
            value = F.concat(F.lit(f'{name}: "'), yaml_escape(c), F.lit('"'))
            rows.append(F.when(c != "", value))
    return F.concat_ws("\n", F.lit("---"), *rows, F.lit("---"))


SITE_FIELDS = {
    "policies": (("url", "source_url"), ("scrapedAt", "ingested_at")),
    "blog": (("date", "date"), ("author", "author"), ("url", "source_url"),
             ("scrapedAt", "ingested_at")),
    "events": (("date", "date"), ("when", "time"), ("venue", "venue"), ("address", "address"),
               ("location", "location"), ("url", "source_url"), ("scrapedAt", "ingested_at")),
    "team": (("role", "role"), ("electorate", "electorate"), ("url", "source_url"),
             ("scrapedAt", "ingested_at")),
    "party-info": (("url", "source_url"), ("scrapedAt", "ingested_at")),
}


def site_frontmatter(collection: str) -> Column:
    """Published frontmatter of a collection over the clean columns."""
    if collection == "team":
        head, default = "name", slug_title(F.col("slug"))
    else:
        plain = collection in ("blog", "events")
        head, default = "title", F.col("slug") if plain else slug_title(F.col("slug"))
    title = F.coalesce(blank_to_null(F.col(head)), default)
    rows = [
        F.concat(F.lit(f'{head}: "'), quote_escape(title), F.lit('"')),
        F.concat(F.lit("slug: "), F.col("slug")),
    ]
    for name, source in SITE_FIELDS[collection]:
        c = F.col(source)
        rows.append(F.when(c != "", F.concat(F.lit(f'{name}: "'), quote_escape(c), F.lit('"'))))
    if collection == "policies":
        urls = F.col("pdf_urls")
        items = F.transform(urls, lambda u: F.concat(F.lit('\n  - "'), quote_escape(u), F.lit('"')))
        block = F.concat(F.lit("pdfDownloads:"), F.array_join(items, ""))
        rows.append(F.when(F.size(urls) > 0, block))
    return F.concat_ws("\n", F.lit("---"), *rows, F.lit("---"))


def strip_frontmatter(text: Column) -> Column:

    def body(parts: Column) -> Column:
        return F.when((parts[0] == "") & (F.size(parts) >= 3), parts[2])

    return let(text, lambda t: F.coalesce(let(F.split(t, "---\n", 3), body), t))


def strip_frontmatter_block(text: Column) -> Column:
    """The publishing twin: a block closed by a line of its own."""
    return sub(text, r"(?s)\A---\n.*?\n---\n", "")


def doc_title(text: Column, slug: Column) -> Column:
    title = rf"""(?md)^title:{WS}*["']?([^"'\n]+)["']?{WS}*$"""
    h1 = rf"(?md)^#{WS}+(.+)$"
    return let(
        text,
        lambda t: F.when(t.rlike(title), strip(F.regexp_extract(t, title, 1)))
        .when(t.rlike(h1), strip(F.regexp_extract(t, h1, 1)))
        .otherwise(slug),
    )


# --- profile pages ----------------------------------------------------------


def strip_protected_emails(md: Column) -> Column:
    return sub(
        md, r"(?i)\[[^\[\]]*(?:\[[^\]]*\][^\[\]]*)*\]\(/cdn-cgi/l/email-protection[^)]*\)", ""
    )


def clean_profile_markdown(md: Column) -> Column:
    out = cut_at(strip_protected_emails(md), rf"(?mid)^#{{1,6}}{WS}+Donate\b")
    out = sub(out, r"((?:#{1,6} [^\n]+\n\n){1,3})\1", "$1")
    return rstrip(collapse_blank_runs(out))


def strip_redundant_headings(md: Column, name: Column, electorate: Column) -> Column:
    """Drop headings that repeat a member's name or electorate; keep the first `# Name`."""
    area = F.concat(F.lit(rf"(?md)^####{WS}+"), quoted(F.upper(electorate)), F.lit(rf"{WS}*\n+"))
    out = F.when(electorate != "", F.regexp_replace(md, area, F.lit(""))).otherwise(md)
    q = quoted(name)

    h1 = F.concat(F.lit(rf"(?md)^#{WS}+\*{{0,2}}"), q, F.lit(rf"\*{{0,2}}{WS}*\n+"))

    def keep_first(x: Column) -> Column:
        size = F.coalesce(F.length(F.regexp_substr(x, h1)), F.lit(0))
        end = F.regexp_instr(x, h1) - F.lit(1) + size
        rest = F.regexp_replace(F.substr(x, end + F.lit(1)), h1, F.lit(""))
        return F.when(size > 0, F.concat(F.left(x, end), rest)).otherwise(x)

    about = F.concat(
        F.lit(rf"(?md)^##{WS}+\*{{0,2}}"), q, F.lit(rf"(?:{WS}+\([^)]*\))?\*{{0,2}}{WS}*$")
    )


    def rename(x: Column) -> Column:
        named = F.regexp_replace(keep_first(x), about, F.lit("## About"))
        return F.when(name != "", named).otherwise(x)

    return strip(collapse_blank_runs(let(out, rename)))


# --- PDF text ---------------------------------------------------------------

INLINE_GLYPHS = "".join(map(chr, range(0x200B, 0x2010))) + "\ufeff\ufffd\u00ad"
# the rare class leads, so the lookarounds run only where it matches
_PUA = "[\ue000-\uf8ff](?<=[A-Za-z].)(?=[A-Za-z])"


def strip_glyphs(text: Column) -> Column:
    return sub(F.translate(text, INLINE_GLYPHS, ""), _PUA, "")


_HEADER_FIELD = rf"(?d)({'|'.join(rules.PDF_HEADER_FIELDS)}){WS}+\*\*(.+?)\*\*"


def clean_pdf_body(raw: Column, footers=rules.PAGE_FOOTERS) -> Column:
    """Extracted PDF markdown without placeholders, running footers and the header line."""
    picture = rf"(?d)^{WS}*\**==>{WS}*picture.*<==\**{WS}*\z"
    page = "|".join([*footers, rf"^Page{WS}+\d+{WS}*\z"])

    def noise(line: Column) -> Column:
        bare = strip(F.btrim(strip(line), F.lit("*")))
        header = strip(line).startswith("Date") & line.rlike(_HEADER_FIELD)
        return (line.contains("==>") & strip(line).rlike(picture)) | bare.rlike(page) | header

    kept = F.transform(F.filter(lines(raw), lambda x: ~noise(x)), rstrip)
    return strip(strip_glyphs(collapse_blank_runs(unlines(kept))))


def pdf_header_field(raw: Column, key: str) -> Column:
    """Last bold value of one header key, empty when absent.

    Matched over all keys at once, so a value that itself contains another
    key's text is not read twice.
    """
    hits = F.regexp_extract_all(raw, F.lit(_HEADER_FIELD), F.lit(0))
    mine = F.filter(hits, lambda h: h.startswith(key))
    value = F.regexp_extract(F.try_element_at(mine, F.lit(-1)), _HEADER_FIELD, 2)
    return F.coalesce(strip(value), F.lit(""))


def pdf_header(raw: Column) -> Column:
    names = rules.PDF_HEADER_FIELDS
    keys = F.array(*[F.lit(n.lower().replace(" ", "_")) for n in names])
    full = F.map_from_arrays(keys, F.array(*[pdf_header_field(raw, n) for n in names]))
    return F.map_filter(full, lambda _, v: v != "")


def format_pdf_markdown(
    date: Column, policy: Column, doc_type: Column, body: Column, file: Column, slug: Column
) -> Column:
    """Header fields, source file and body as one titled markdown document."""
    plain = (doc_type == "") | (F.lower(doc_type) == "policy overview")
    named = F.when(plain, policy).otherwise(F.concat(policy, F.lit(" — "), doc_type))
    stem = title_case(F.translate(sub(file, r"\.[^.]*$", ""), "_-", "  "))
    fallback = F.when(slug != "", slug_title(slug)).otherwise(stem)
    title = F.when(named != "", named).otherwise(fallback)

    def row(label: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(f"| {label} | "), c, F.lit(" |")))

    return F.concat(
        F.concat_ws(
            "\n",
            F.concat(F.lit("# "), title),
            F.lit(""),
            F.lit("| Field | Value |\n|-------|-------|"),
            row("Date", date),
            row("Policy", policy),
            row("Document Type", doc_type),
            F.concat(F.lit("| Source | `"), file, F.lit("` |")),
            F.lit(""),
            body,
        ),
        F.lit("\n"),
    )


def format_party_pdf(label: Column, url: Column, raw: Column) -> Column:
    text = strip(collapse_blank_runs(raw))
    return F.concat(
        F.lit("# "), slug_title(label), F.lit("\n\n> **Source**: "), url, F.lit("\n\n"), text,
        F.lit("\n"),
    )


# The sections that get appended start with an H1, so the default cut looks for one.
SECTION_SENTINEL = "\n\n---\n\n# "


def section_base(text: Column, sentinel: str = SECTION_SENTINEL) -> Column:
    """Page text before the first appended section."""
    return rstrip(F.split(text, sentinel, 2)[0])


# --- record layouts ---------------------------------------------------------


def _meta_line(key: str, c: Column, optional: bool = True) -> Column:
    line = F.concat(F.lit(f"**{key}**: "), c)
    return F.when(c != "", line) if optional else line


def _page_md(title: Column, url: Column, scraped: Column, content: Column) -> Column:
    return F.concat(
        F.lit("# "), title, F.lit("\n\n> **URL**: "), url, F.lit("\n> **Scraped**: "), scraped,
        F.lit("\n\n"), content, F.lit("\n"),
    )


def policy_md(title: Column, url: Column, scraped: Column, content: Column) -> Column:
    return _page_md(title, url, scraped, content)


def info_md(section: Column, url: Column, scraped: Column, content: Column) -> Column:
    return _page_md(slug_title(section), url, scraped, content)


def blog_md(
    title: Column, date: Column, author: Column, url: Column, scraped: Column, content: Column
) -> Column:
    meta = F.concat_ws(
        "\n",
        _meta_line("Title", title, False),
        _meta_line("Date", date),
        _meta_line("Author", author),
        _meta_line("URL", url, False),
        _meta_line("Scraped", scraped, False),
    )
    return F.concat(meta, F.lit("\n\n"), content, F.lit("\n"))


def event_md(
    title: Column, date: Column, time: Column, location: Column, url: Column, scraped: Column,
    description: Column,
) -> Column:
    meta = F.concat_ws(
        "\n",
        _meta_line("Title", title, False),
        _meta_line("Date", date),
        _meta_line("Time", time),
        _meta_line("Location", location),
        _meta_line("URL", url, False),
        _meta_line("Scraped", scraped, False),
    )
    return F.concat(meta, F.lit("\n\n"), description, F.lit("\n"))


def member_md(
    name: Column, role: Column, electorate: Column, url: Column, scraped: Column, content: Column
) -> Column:
    gap = F.when((role != "") | (electorate != ""), F.lit(""))
    return F.concat(
        F.concat_ws(
            "\n",
            F.concat(F.lit("# "), name),
            F.lit(""),
            _meta_line("Role", role),
            _meta_line("Electorate", electorate),
            gap,
            F.concat(F.lit("> **URL**: "), url),
            F.concat(F.lit("> **Scraped**: "), scraped),
            F.lit(""),
            strip_redundant_headings(content, name, electorate),
        ),
        F.lit("\n"),
    )


# --- listings ---------------------------------------------------------------


def summary(text: Column, words: int) -> Column:
    """First `words` words of the plain text, with an ellipsis when cut."""
    plain = sub(text, rf"(?md)^#+{WS}+", "")
    plain = F.replace(plain, F.lit("*"), F.lit(""))
    plain = sub(plain, r"\[([^\]]+)\]\([^)]+\)", "$1")
    plain = strip(sub(plain, rf"(?md)^[>-]{WS}*", ""))


    def cut(parts: Column) -> Column:
        more = F.when(F.size(parts) > words, "…").otherwise("")
        return F.concat(F.array_join(F.slice(parts, 1, words), " "), more)

    # the rest of the text stays in one last part
    return let(F.split(plain, f"{WS}+", words + 1), cut)


_ROOT_LINK = r"\]\(/([^)]+)\)"


def absolutize_links(md: Column, base: str) -> tuple[Column, Column]:
    """(markdown with root-relative links made absolute, how many)."""
    prefix = base.rstrip("/").replace("\\", "\\\\").replace("$", "\\$")
    return sub(md, _ROOT_LINK, f"]({prefix}/$1)"), F.regexp_count(md, F.lit(_ROOT_LINK))


def item_page(title: Column, date: Column, author: Column, body: Column) -> Column:
    """Single-item page; absent date or author leaves its line blank."""
    def bold(key: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(f"**{key}:** "), c)).otherwise("")

    return F.concat_ws(
        "\n", F.concat(F.lit("# "), title), F.lit(""), bold("Date", date), bold("Author", author),
        F.lit(""), strip(body),
    )


