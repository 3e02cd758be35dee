"""HTML extraction as Column expressions over raw page source.

Selectors are matched with patterns, so a page may be badly formed.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.text import (
    display_date,
    first_nonblank,
    label_slug,
    let,
    slug_title,
    strip,
    sub,
    title_case,
)
from corpusloom.rules import WS

_MARK = "\x01"

# name -> character, as one delimited string that folds to a literal map
_NAMED = "\x02".join(
    f"{name}\x03{chr(code)}" for name, code in sorted({**name2codepoint, "apos": 39}.items())
)
_REF = "&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _character(ref: Column) -> Column:
    """The character a reference stands for; null when it stands for none."""
    body = F.regexp_replace(ref, "[&;]", "")
    named = F.try_element_at(F.str_to_map(F.lit(_NAMED), F.lit("\x02"), F.lit("\x03")), body)
    number = (
        F.when(body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10))
        .otherwise(F.substr(body, F.lit(2)))
        .cast("bigint")
    )

    def by_number(n: Column) -> Column:
        valid = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    return F.when(
        body.startswith("#"), let(F.when(body.startswith("#"), number), by_number)
    ).otherwise(named)


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal references.

    Those that yield an ampersand are replaced last, so nothing decodes twice.
    """

    def decode(t: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(t, F.lit(_REF), F.lit(0)))
        pairs = F.transform(
            refs,
            lambda r: F.struct((_character(r) == "&").alias("amp"), r.alias("ref"),
                               _character(r).alias("to")),
        )
        known = F.array_sort(F.filter(pairs, lambda p: p["to"].isNotNull()))
        return F.aggregate(known, t, lambda acc, p: F.replace(acc, p["ref"], p["to"]))

    return let(text, lambda t: F.when(t.contains("&"), decode(t)).otherwise(t))


_UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def text_nodes(html: Column) -> Column:
    """Stripped, non-empty text nodes in document order."""
    marked = sub(sub(html, _UNSEEN, _MARK), r"(?s)<[^>]*>", _MARK)
    nodes = F.transform(F.split(decode_entities(marked), _MARK, -1), strip)
    return F.filter(nodes, lambda n: n != "")


def _nonempty(text: Column) -> Column:
    return F.when(text != "", text)


def html_text(html: Column, separator: str = "") -> Column:
    return F.array_join(text_nodes(html), separator)


# --- elements ----------------------------------------------------------------
#
# An element is an opening tag with the closing tag that belongs to it: a closing
# tag belongs to the nearest open one of its name. Tags left open, stray closing
# tags, and tags in comments, scripts and styles make no element. Most pages use
# a name once, and there the first closing tag is the right one, so they are read
# by pattern; the fold over a page's tags is for the others.

_RAW = ("<!--", "<script", "<style")  # what hides tags, with what ends it
_RAW_END = ("-->", "</script", "</style")


def _cut(html: Column, name: Column) -> Column:
    """The page cut before every tag of a name and before the ends of what hides tags."""
    names = F.concat(F.lit(r"(?i)(?=<!--|-->|</?(?:script|style|"), name, F.lit(r")\b)"))
    return F.split(html, names, -1)


def _pairs(pieces: Column, name: Column) -> Column:
    """array<struct<a, b>>: pieces that open and close an element, in order of their opening.

    One fold with the numbers of the open tags as a stack. `hidden` tells which
    of the raw regions the fold is in; 0 is none.
    """
    opening, closing = F.concat(F.lit("<"), name), F.concat(F.lit("</"), name)
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("hidden"), F.array().cast("array<int>").alias("open"),
        F.array().cast("array<struct<a:int,b:int>>").alias("pairs"),
    )

    def step(acc: Column, piece: Column) -> Column:
        low = F.lower(F.substr(piece, F.lit(1), F.length(closing) + 8))

        def begins(word: Column) -> Column:
            after = F.substr(low, F.length(word) + 1, F.lit(1))
            return low.startswith(word) & ~after.rlike(r"\w")

        hidden = F.lit(0)
        for k, (head, end) in enumerate(zip(_RAW, _RAW_END, strict=True), 1):
            hidden = F.when(acc["hidden"] == k, F.when(low.startswith(end), 0).otherwise(k)).when(
                (acc["hidden"] == 0) & low.startswith(head), k).otherwise(hidden)
        seen = (acc["hidden"] == 0) & (hidden == 0)
        closes = seen & begins(F.lower(closing)) & (F.size(acc["open"]) > 0)
        pair = F.struct(F.element_at(acc["open"], -1).alias("a"), acc["i"].alias("b"))
        return F.struct(
            (acc["i"] + 1).alias("i"), hidden.alias("hidden"),
            F.when(seen & begins(F.lower(opening)), F.array_append(acc["open"], acc["i"]))
            .when(closes, F.slice(acc["open"], F.lit(1), F.size(acc["open"]) - 1)).otherwise(acc["open"]).alias("open"),
            F.when(closes, F.array_append(acc["pairs"], pair)).otherwise(acc["pairs"]).alias("pairs"),
        )

    return F.aggregate(pieces, start, step, lambda acc: F.array_sort(acc["pairs"]))


def _inner(pieces: Column, pair: Column) -> Column:
    """What stands between the two tags of an element."""
    whole = F.array_join(F.slice(pieces, pair["a"] + 1, pair["b"] - pair["a"]), "")
    return F.regexp_replace(whole, r"^<[^>]*>", "")


def _balanced(html: Column, name: Column, opening: str = "") -> Column:
    """Inner HTML of all elements of a name whose opening tag shows a pattern, in document order."""
    def of(pieces: Column) -> Column:
        def wanted(pair: Column) -> Column:
            return F.get(pieces, pair["a"]).rlike(rf"(?is)^<[^>]*{opening}")

        found = _pairs(pieces, name)
        return F.transform(F.filter(found, wanted) if opening else found, lambda pair: _inner(pieces, pair))

    return let(_cut(html, name), of)


def _without(html: Column, tag: str) -> Column:
    """The page without the elements of a tag, whatever they hold."""
    def of(pieces: Column) -> Column:
        def outside(pairs: Column) -> Column:
            def rest(piece: Column, i: Column) -> Column:
                inside = F.exists(pairs, lambda p: (p["a"] <= i) & (i < p["b"]))
                ends = F.exists(pairs, lambda p: p["b"] == i)
                return F.when(inside, "").when(ends, F.regexp_replace(piece, r"^<[^>]*>", "")).otherwise(piece)

            return F.array_join(F.transform(pieces, rest), "")

        return let(_pairs(pieces, F.lit(tag)), outside)

    return let(_cut(html, F.lit(tag)), of)


def _tags(html: Column, tag: str) -> Column:
    return F.regexp_count(html, F.lit(rf"(?i)</?{tag}\b"))


def drop_boilerplate(html: Column, tags=rules.BOILERPLATE_TAGS) -> Column:
    """The page without the elements of some tags. Scripts and styles end at the first tag that closes them."""
    raw = [t for t in tags if f"<{t}" in _RAW]
    out = sub(html, "(?is)" + "|".join(rf"<{t}\b.*?</{t}\s*>" for t in raw), "") if raw else html
    rest = [t for t in tags if t not in raw]
    if not rest:
        return out
    plain = "(?is)" + "|".join(rf"<{t}\b.*?</{t}\s*>" for t in rest)

    def dropped(page: Column) -> Column:
        nested = F.lit(False)
        for t in rest:
            nested = nested | (_tags(page, t) > 2)
        whole = page
        for t in rest:
            whole = _without(whole, t)
        return F.when(nested, whole).otherwise(sub(page, plain, ""))

    return let(out, dropped)


def element(html: Column, tag: str) -> Column:
    """Inner HTML of the first element of a tag; empty when absent."""
    plain = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    first = F.coalesce(F.get(_balanced(html, F.lit(tag)), 0), F.lit(""))
    return F.when(_tags(html, tag) > 2, first).otherwise(plain)


def elements(html: Column, tag: str, opening: str = "") -> Column:
    """Inner HTML of all elements of a tag, nested ones too, whose opening tag shows a pattern."""
    plain = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*{opening}[^>]*>(.*?)</{tag}\s*>"), F.lit(1))

    def checked(found: Column) -> Column:
        nested = F.exists(found, lambda inner: inner.rlike(rf"(?i)<{tag}\b") | inner.contains("<!--"))
        return F.when(nested, _balanced(html, F.lit(tag), opening)).otherwise(found)

    return let(plain, checked)


def _attr_element(html: Column, attr: str) -> Column:
    """Inner HTML of the first element whose opening tag shows a pattern, whatever its name."""
    head = rf"(?is)<(\w+)\b[^>]*\b{attr}[^>]*>"

    def whole(found: Column) -> Column:
        opening = F.regexp_extract(html, head, 0)
        rest = F.substr(html, F.instr(html, opening).cast("int"))
        nested = F.get(_balanced(rest, F.regexp_extract(opening, r"^<(\w+)", 1), attr), 0)
        plain = F.regexp_extract(found, rf"{head}(.*?)</\1\s*>", 2)
        return F.when(found.rlike(r"(?is)^<(\w+)\b.+<\1\b|<!--"), F.coalesce(nested, F.lit(""))).otherwise(plain)

    return let(F.regexp_extract(html, rf"{head}(.*?)</\1\s*>", 0), whole)


def _class_attr(name: str) -> str:
    return rf"""class\s*=\s*["'][^"'>]*(?<![\w-]){name}(?![\w-])[^"'>]*["']"""


def by_class(html: Column, name: str) -> Column:
    return _attr_element(html, _class_attr(name))


def by_id(html: Column, name: str) -> Column:
    return _attr_element(html, rf"""id\s*=\s*["']{name}["']""")


def by_role(html: Column, name: str) -> Column:
    return _attr_element(html, rf"""role\s*=\s*["']{name}["']""")


def content_regions(html: Column, wide: bool = False) -> list[Column]:
    """Candidate content regions in order of preference, each empty when absent.

    A plain search for the name comes first, as most pages have few of them.
    """
    def named(word: str, region: Column) -> Column:
        return F.when(html.rlike(f"(?i){word}"), region).otherwise("")

    first = [
        named("<main", element(html, "main")),
        named("role", by_role(html, "main")),
        named("page-content", by_class(html, "page-content")),
    ]
    if wide:
        first += [
            named("content", by_id(html, "content")),
            named("content", by_class(html, "content")),
            named("main-content", by_class(html, "main-content")),
        ]
    return [*first, element(html, "article")]


def body_html(html: Column) -> Column:
    return drop_boilerplate(element(html, "body"))


def _long_enough(html: Column, threshold: int, wide: bool = False) -> list[Column]:
    def keep(region: Column) -> Column:
        long = (F.length(region) > threshold) & (F.length(html_text(region)) > threshold)
        return F.when(long, region)

    return [let(r, keep) for r in content_regions(html, wide)]


def main_content(html: Column, threshold: int = 50, fall_back: bool = False) -> Column:
    """First region with more than `threshold` characters of text.

    With `fall_back` the body without boilerplate is used, else an empty string.
    """
    return F.coalesce(
        *_long_enough(html, threshold), body_html(html) if fall_back else F.lit("")
    )


def main_text(html: Column, threshold: int = 100) -> Column:
    """Newline-joined text of the content region, the body or the whole page.

    A region's text is taken apart once, for its length and for the result.
    """
    def told(region: Column) -> Column:
        joined = let(text_nodes(region), lambda nodes: F.when(
            F.length(F.array_join(nodes, "")) > threshold, F.array_join(nodes, "\n")))
        return F.when(F.length(region) > threshold, joined)

    picks = [let(r, told) for r in content_regions(html, wide=True)]
    rest = F.coalesce(F.when(html.rlike(r"(?i)<body\b"), body_html(html)), html)
    return F.coalesce(*picks, html_text(rest, "\n"))


def html_to_markdown(html: Column) -> Column:
    """ATX markdown of a fragment whose inline tags are properly closed.

    A tag left open contributes its text without markup.
    """
    out = sub(html, _UNSEEN, "")
    out = sub(out, r"[\t \r\n]+", " ")
    out = sub(out, r"(?<!\\)([*_])(?![^<>]*>)", r"\\$1")
    out = sub(
        out, r"""(?is)<img\b(?=[^>]*?\bsrc="([^"]*)")(?:(?=[^>]*?\balt="([^"]*)"))?[^>]*>""",
        "![$2]($1)",
    )
    out = sub(out, r"(?is)<(?:b|strong)(?:\s[^>]*)?>\s*([^<>]+?)\s*</(?:b|strong)\s*>", "**$1**")
    out = sub(out, r"(?is)<(?:i|em)(?:\s[^>]*)?>\s*([^<>]+?)\s*</(?:i|em)\s*>", "*$1*")
    out = sub(
        out, r"""(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>\s*([^<>]+?)\s*</a\s*>""", "[$2]($1)"
    )
    for level in range(1, 7):
        out = sub(
            out, rf"(?is)<h{level}\b[^>]*>\s*(.*?)\s*</h{level}\s*>", f"\n\n{'#' * level} $1\n\n"
        )
    out = sub(out, r"(?is)<li\b[^>]*>\s*(.*?)\s*</li\s*>", "\n* $1")
    out = sub(out, r"(?i)<br\b[^>]*>", "  \n")
    out = sub(out, r"(?i)</?(?:p|ul|ol|div|section|article)\b[^>]*>", "\n\n")
    out = decode_entities(sub(out, r"(?s)<[^>]*>", ""))
    return strip(sub(sub(out, r"\n ", "\n"), r"\n{3,}", "\n\n"))


def has_element(html: Column, tag: str) -> Column:
    return html.rlike(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")


def title_tag(html: Column) -> Column:
    name = strip(F.split(html_text(element(html, "title")), r"\|", -1)[0])
    return F.when(has_element(html, "title"), name)


def page_title(html: Column) -> Column:
    h1 = F.when(has_element(html, "h1"), html_text(element(html, "h1")))
    return F.coalesce(h1, title_tag(html), F.lit("Unknown"))


def first_region(html: Column) -> Column:
    """The content region whatever its length; null when the page has none."""
    hits = [F.nullif(r, F.lit("")) for r in content_regions(html)]
    return F.coalesce(*hits)


def person_title(html: Column) -> Column:
    def spaced(h1: Column) -> Column:
        return sub(html_text(h1, " "), rf"{WS}{{2,}}", " ")

    region = first_region(html)
    inside = F.when(has_element(region, "h1"), spaced(element(region, "h1")))
    others = F.filter(
        F.transform(elements(html, "h1"), spaced),
        lambda t: (t != "") & ~F.lower(t).contains("sign in") & ~F.lower(t).contains("log in"),
    )
    return F.coalesce(inside, F.get(others, 0), title_tag(html), F.lit("Unknown"))


_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""


def anchors(html: Column) -> Column:
    """array<struct<href, inner, text>> of the page's links in document order."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0)),
        lambda a: F.struct(
            decode_entities(F.regexp_extract(a, _ANCHOR, 1)).alias("href"),
            F.regexp_extract(a, _ANCHOR, 2).alias("inner"),
            html_text(F.regexp_extract(a, _ANCHOR, 2)).alias("text"),
        ),
    )


def is_pdf_link(href: Column, host: str = rules.FILE_HOST) -> Column:
    return href.contains(host) | F.lower(href).endswith(".pdf")


_LABEL = r"(?is)<(h3|h4|h5|strong)\b[^>]*>(.*?)</\1\s*>"


def labelled_pdf_links(html: Column, host: str = rules.FILE_HOST) -> Column:
    """array<struct<label, href>>: list items that hold a hosted file link."""
    def entry(li: Column) -> Column:
        link = F.get(F.filter(anchors(li), lambda a: a["href"].contains(f"{host}/file/d/")), 0)
        heading = F.when(li.rlike(_LABEL), html_text(F.regexp_extract(li, _LABEL, 2)))
        label = label_slug(F.coalesce(heading, link["text"]))
        return F.struct(label.alias("label"), link["href"].alias("href"))

    found = F.transform(elements(html, "li"), entry)
    return F.filter(found, lambda e: e["href"].isNotNull() & (e["label"] != ""))


def sublink_name(text: Column, href: Column) -> Column:
    tail = F.element_at(F.split(F.btrim(href, F.lit("/")), "/", -1), -1)
    return F.when(text != "", text).otherwise(F.replace(tail, F.lit("-"), F.lit(" ")))


def member_name(inner: Column, slug: Column) -> Column:
    head = r"(?is)<(h2|h3|h4)\b[^>]*>(.*?)</\1\s*>"
    strong = r"(?is)<strong\b[^>]*>(.*?)</strong\s*>"
    return (
        F.when(inner.rlike(head), html_text(F.regexp_extract(inner, head, 2)))
        .when(inner.rlike(strong), html_text(F.regexp_extract(inner, strong, 1)))
        .otherwise(slug_title(slug))
    )


def role_from_text(text: Column) -> Column:
    """First role of the ladder named in a block of text; null when none is."""
    low = F.lower(text)
    out = F.when(F.lit(False), F.lit(""))
    for needle, role in rules.ROLE_LADDER:
        out = out.when(low.contains(needle), role)
    return out


_BLOCK_END = r"(?i)</(?:p|div|h[1-6]|ul|ol|table|section|article)\s*>"


def classify_role(html: Column) -> Column:
    """Role named after the media-contact heading.

    Each block of text after the heading is tried in turn, so the first one
    that names a role decides.
    """
    region = F.coalesce(first_region(html), html)
    contact = r"(?is)<(h5|h6)\b[^>]*>(?:(?!</\1).)*?media contact.*?</\1\s*>"
    blocks = F.split(F.get(F.split(region, contact, 2), 1), _BLOCK_END, -1)
    roles = F.filter(
        F.transform(blocks, lambda b: role_from_text(html_text(b, " "))), lambda r: r.isNotNull()
    )
    return F.coalesce(F.get(roles, 0), F.lit(rules.DEFAULT_ROLE))


def electorate(html: Column) -> Column:
    region = F.coalesce(first_region(html), html)
    shouted = F.filter(
        F.transform(elements(region, "h4"), lambda h: html_text(h)),
        lambda t: (F.length(t) <= 80)
        & (t == F.upper(t))
        & t.rlike(r"\p{L}")
        & ~F.lower(t).isin(*rules.NOT_ELECTORATES),
    )
    return F.coalesce(title_case(F.get(shouted, 0)), F.lit(""))


def strip_protected_links(html: Column) -> Column:
    return sub(
        html, r"""(?is)<a\b[^>]*?\bhref\s*=\s*["'][^"']*/cdn-cgi/l/email-protection.*?</a\s*>""", ""
    )


# --- event cards ------------------------------------------------------------


def event_cards(html: Column, tag: str = "div") -> Column:
    """Inner HTML of every `.event-card`, whatever elements it holds."""
    return elements(html, tag, _class_attr("event-card"))


def is_date_like(text: Column) -> Column:
    return strip(text).rlike(rules.MONTH_PREFIX)


def is_location_like(text: Column) -> Column:
    return text.contains(",") & (F.length(text) > 10)


def event_title(card: Column) -> Column:
    picks = [
        F.when(card.rlike(rf"(?is)<\w+\b[^>]*{_class_attr('event__name')}"),
               html_text(by_class(card, "event__name"))),
        F.when(has_element(card, "h3"), html_text(element(card, "h3"))),
        F.when(has_element(card, "h4"), html_text(element(card, "h4"))),
        F.when(card.rlike(rf"(?is)<\w+\b[^>]*{_class_attr('title')}"),
               html_text(by_class(card, "title"))),
    ]
    free = F.filter(
        F.split(html_text(card, "\n"), "\n", -1),
        lambda p: ~is_date_like(p) & ~is_location_like(p) & (F.length(p) > 3),
    )
    return F.coalesce(*picks, F.get(free, 0), F.lit("Untitled Event"))


def _card_parts(card: Column) -> Column:
    return F.transform(F.split(html_text(card, "|"), r"\|", -1), strip)


def event_date(card: Column) -> Column:
    return display_date(_card_parts(card)[0])


def event_location(card: Column) -> Column:
    def pick(parts: Column) -> Column:
        return (
            F.when(F.size(parts) >= 3, F.get(parts, 2))
            .when((F.size(parts) >= 2) & ~is_date_like(F.get(parts, 1)), F.get(parts, 1))
            .otherwise("")
        )

    return let(_card_parts(card), pick)


def card_url(card: Column, base: str) -> Column:
    href = F.get(anchors(card), 0)["href"]
    path = F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href))
    return F.concat(F.lit(base), path)


def _event_times(when: Column) -> Column:
    """The texts beside the calendar and the clock."""
    def after_icon(icon: str) -> Column:
        node = F.regexp_extract(
            when, rf"(?is)<i\b[^>]*{_class_attr(icon)}[^>]*>\s*</i>\s*([^<]*)", 1
        )
        return let(strip(decode_entities(node)), _nonempty)

    return F.concat_ws(" · ", after_icon("fa-calendar"), after_icon("fa-clock"))


def _event_venue(where: Column) -> Column:
    return html_text(F.coalesce(let(element(where, "h4"), _nonempty), by_class(where, "h4")))


def _event_address(where: Column) -> Column:
    return F.coalesce(
        F.get(
            F.filter(anchors(where), lambda a: a["href"].contains("maps.google")), 0
        )["text"],
        F.lit(""),
    )


def _event_head(main: Column) -> Column:
    """When, Venue and Address lines of an event's header."""
    header = F.regexp_extract(
        main,
        rf"(?is)<(\w+)\b[^>]*(?:{_class_attr('event-header')}|aria-label=\"Event info\")"
        r"[^>]*>(.*?)</\1\s*>", 2,
    )

    def column(given: Column, label: str) -> Column:
        head = rf"<span\b[^>]*{_class_attr('event-header-column-headline')}[^>]*>\s*"
        return F.regexp_extract(
            given, rf"(?is){head}{label}\s*</span>(.*?)(?={head}|\z)", 1
        )

    def line(label: str, text: Column) -> Column:
        return let(text, lambda t: F.when(t != "", F.concat(F.lit(f"**{label}**: "), t)))

    def of(given: Column) -> Column:
        where = let(
            column(given, "Where"),
            lambda w: F.concat_ws("\n", line("Venue", _event_venue(w)), line("Address", _event_address(w))),
        )
        when = line("When", let(column(given, "When"), _event_times))
        return F.concat_ws("\n", when, let(where, _nonempty))

    return let(header, of)


def _event_intro(main: Column) -> Column:
    picks = (by_id(main, "intro"), by_class(main, "intro"), by_class(main, "event-description"),
             by_class(main, "page-body"))
    intro = F.coalesce(*[let(p, _nonempty) for p in picks], F.lit(""))
    kept = F.filter(
        F.split(html_to_markdown(intro), "\n", -1),
        lambda x: ~x.contains("RSVP") | (F.length(x) > 20),
    )
    return F.array_join(kept, "\n")


def event_detail(html: Column) -> Column:
    """When, Venue, Address lines and the intro of an event's own page.

    Every part is bound before it is read twice, so the expression grows with the
    number of parts, not with the product of their mentions.
    """
    def of(main: Column) -> Column:
        head = let(_event_head(main), lambda h: F.when(h != "", F.concat(h, F.lit("\n\n"))).otherwise(""))
        return strip(F.concat(head, _event_intro(main)))

    def region(page: Column) -> Column:
        return F.coalesce(*[let(r, _nonempty) for r in content_regions(page)[:3]], F.lit(""))

    return let(let(html, region), of)


def external_urls(html: Column) -> Column:
    """Absolute http(s) link targets; root-relative ones are not external."""
    return F.filter(
        F.transform(anchors(html), lambda a: a["href"]), lambda h: h.rlike("^https?://")
    )

