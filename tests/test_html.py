import random
from html import unescape

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import compare as V
from corpusloom.functions import html as H


@pytest.mark.parametrize("raw", [
    "a &amp; b", "&amp;lt;", "&lt;b&gt; &copy;&nbsp;2026", "&#39;&#x27;&#X1F600;", "&#8212; &eacute;",
    "&nosuch; & &;", "&amp;amp;", "plain",
])
def test_entities(one, raw):
    assert one(H.decode_entities, raw) == unescape(raw)


def test_invalid_references_stay(one):
    assert one(H.decode_entities, "&#0; &#xD800; &#9999999;") == "&#0; &#xD800; &#9999999;"


def test_text_nodes(one):
    html = '<p> a <b>b</b></p><!-- <i>no</i> --><script>x="</p>"</script><style>p{}</style> &nbsp; <br>c'
    assert one(lambda h: H.html_text(h, "|"), html) == "a|b|c"


def test_boilerplate(one):
    html = "<header>h</header><NAV>n</NAV ><p>keep</p><footer>f</footer><navy>x</navy>"
    assert one(H.drop_boilerplate, html) == "<p>keep</p><navy>x</navy>"


def test_main_content_cascade(one):
    long = "word " * 30
    assert one(lambda h: H.main_content(h, 50), f"<main>short</main><article>{long}</article>") == long
    assert one(lambda h: H.main_content(h, 50), f'<div ROLE="main">{long}</div>') == long
    assert one(lambda h: H.main_content(h, 50), f"<div class='x page-content y'>{long}</div>") == long
    assert one(lambda h: H.main_content(h, 50), f"<div class='page-contents'>{long}</div>") == ""
    body = "<body><nav>n</nav><p>b</p></body>"
    assert one(lambda h: H.main_content(h, 50, True), body) == "<p>b</p>"
    assert one(lambda h: H.main_text(h, 5), '<div id="content"><p>one</p><p>two!</p></div>') == "one\ntwo!"
    assert one(lambda h: H.main_text(h, 5), "<p>x</p>") == "x"


def test_titles(one):
    assert one(H.page_title, "<title>A | B</title><h1> Head <i>x</i></h1>") == "Headx"
    assert one(H.page_title, "<title> A | B</title>") == "A"
    assert one(H.page_title, "<h1></h1><title>A</title>") == ""
    assert one(H.page_title, "<p>") == "Unknown"
    assert one(H.person_title, "<h1>Log in</h1><h1>Jo   <b>Li</b></h1>") == "Jo Li"
    assert one(H.person_title, "<h1>Log in</h1><title>T | x</title>") == "T"


def test_markdown(one):
    html = ('<h2>A_b</h2><p>x <strong>bold</strong> <em>it</em>\n<a href="/a_b">go*</a></p>'
            '<ul><li>one</li><li>two</li></ul><img src="s.png" alt="al"><br>end')
    assert one(H.html_to_markdown, html) == (
        "## A\\_b\n\nx **bold** *it* [go\\*](/a_b)\n\n* one\n* two\n\n![al](s.png)  \nend")


def test_roles_and_electorate(one):
    page = "<main><h4>KAIPARA KI</h4><h6>Media Contact</h6><p></p><p>Call</p><p>{}</p></main>"
    for text, role in (("Deputy leader", "Deputy Leader"), ("Candidate and Party Leader", "Party Leader"),
                       ("nothing", "Candidate")):
        assert one(H.classify_role, page.format(text)) == role
    assert one(H.classify_role, "<p>party leader</p>") == "Candidate"
    assert one(H.electorate, page) == "Kaipara Ki"
    assert one(H.electorate, "<h4>MEDIA CONTACT</h4><h4>Mixed</h4><h4>12</h4>") == ""


def test_links(one):
    html = ("<li><h3>My Doc (v1)</h3><a class='x' href='https://drive.google.com/file/d/A1/view'>open</a></li>"
            "<li><a href='https://drive.google.com/file/d/B2'>Other one</a></li>"
            "<li><a href='https://drive.google.com/file/d/C3'>!!</a></li><li>none</li>")
    assert [tuple(r) for r in one(H.labelled_pdf_links, html)] == [
        ("my-doc-v1", "https://drive.google.com/file/d/A1/view"),
        ("other-one", "https://drive.google.com/file/d/B2")]
    assert [a["text"] for a in one(H.anchors, html)] == ["open", "Other one", "!!"]


def test_event_card(one):
    card = '<span>June 3, 2026</span><h4>Title</h4><span>Place</span><a href="/e">x</a>'
    assert one(H.event_title, card) == "Title"
    assert one(H.event_date, card) == "2026-06-03"
    assert one(H.event_location, card) == "Place"
    assert one(H.event_title, "<p>Jan 1, 2026</p><p>Somewhere, Far Away</p><p>abc</p>") == "Untitled Event"
    assert one(H.event_location, "<p>x</p><p>March 2</p>") == ""


def test_detail_drops_short_rsvp_lines(one):
    html = '<main><div class="intro"><p>RSVP</p><p>RSVP on our long page here</p></div></main>'
    assert one(H.event_detail, html) == "RSVP on our long page here"
    assert one(H.event_detail, "<article>x</article>") == ""


def test_detail_binds_its_parts(spark):
    """Parts that are read several times are not copied into each other."""
    assert len(str(H.event_detail(F.col("html")))) < 250_000


# --- word comparison --------------------------------------------------------


def brute_tokens(text):
    import re
    import unicodedata

    text = re.sub("[​-‏﻿�­]", "", text)
    text = re.sub("(?<=[A-Za-z])[-](?=[A-Za-z])", "", text)
    text = unicodedata.normalize("NFKD", text)
    return re.findall("[A-Za-z0-9]+", "".join(c for c in text if unicodedata.category(c) != "Mn"))


def test_tokens_match_full_normalisation(spark):
    rng = random.Random(1)
    pool = ([chr(n) for n in range(32, 127)] * 3 + [chr(n) for n in range(0xA0, 0x250)]
            + list("​﻿�’—ﬁ½Ａ́Ж①€"))
    texts = ["".join(rng.choice(pool) for _ in range(40)) for _ in range(500)]
    texts += [chr(n) for n in range(0xA0, 0x2200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(V.with_tokens(df, {"w": "t"}).select("i", "w").collect())
    assert [got[i] for i in range(len(texts))] == [brute_tokens(t) for t in texts]


def test_normalise_matches_full_normalisation(spark):
    import unicodedata

    from pyspark.sql import functions as F

    texts = [f"a{chr(n)}b" for n in range(0xA0, 0xD800) if n not in (0xAD, 0xFFFD)
             and not 0x200B <= n <= 0x200F]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", V.normalise_compare(F.col("t"))).collect())
    for i, t in enumerate(texts):
        want = "".join(c for c in unicodedata.normalize("NFKD", t) if unicodedata.category(c) != "Mn")
        assert got[i] == want


def test_coverage_edges(spark):
    from corpusloom.operators.validate import validate

    rows = [("a.pdf", "One two three", "# One\n\ntwo THREE"), ("b.pdf", "", "x"), ("c.pdf", None, "x"),
            ("d.pdf", " ".join(f"w{i}" for i in range(500)), "w1 w2\n\n- x\n| a |")]
    df = spark.createDataFrame(rows, "filename string, raw_text string, raw_md string")
    got = {r["filename"]: r for r in validate(df).collect()}
    assert got["a.pdf"]["passed"] and got["a.pdf"]["word_coverage"] == 1.0 and got["a.pdf"]["headings"] == 1
    assert got["b.pdf"]["word_coverage"] == 0.0 and not got["b.pdf"]["passed"]
    assert got["c.pdf"]["notes"][0].startswith("exception during validation")
    assert got["d.pdf"]["notes"] == ["word coverage 0.004 < threshold 0.95",
                                    "no headings detected in markdown body"]
    assert (got["d.pdf"]["bullets"], got["d.pdf"]["table_rows"]) == (1, 1)


# --- balanced elements ---------------------------------------------------------


def walk(html, name):
    """Elements of a name by a plain walk over the tags: (start, inner start, inner end, end)."""
    import re

    out, open_tags, at = [], [], 0
    token = re.compile(rf"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<(/?){name}\b[^>]*>")
    while m := token.search(html, at):
        at = m.end()
        if m[1] == "":
            open_tags.append(m)
        elif m[1] == "/" and open_tags:
            o = open_tags.pop()
            out.append((o.start(), o.end(), m.start(), m.end()))
    return sorted(out)


def markup(rng):
    parts = ["<div>", "<div class='event-card x'>", "</div>", "<nav>", "</nav>", "</NAV >", "<Nav a=b>", "<main>", "</main>",
             "<!-- <nav> </main> -->", "<script>'<main></nav>'</script>", "<style>a</style>", "text ", "x&amp;y ", "<navy>",
             "<p>", "</p>", "<br>", "<div id='content'>", "\n", "é▁"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))


def test_balanced_elements_match_a_stack_walk(spark):
    from pyspark.sql import functions as F

    rng = random.Random(7)
    pages = [markup(rng) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = df.select(
        "i", H.element(F.col("h"), "main").alias("main"), H.elements(F.col("h"), "div").alias("divs"),
        H._without(F.col("h"), "nav").alias("rest"), H.event_cards(F.col("h")).alias("cards"),
        H._balanced(F.col("h"), F.lit("main")).alias("mains"),
    ).collect()
    hard = 0
    for r in got:
        page = pages[r["i"]]
        mains, divs, navs = walk(page, "main"), walk(page, "div"), walk(page, "nav")
        assert r["mains"] == [page[b:c] for _, b, c, _ in mains]
        rest, at = "", 0
        for a, _, _, d in navs:
            if a >= at:
                rest, at = rest + page[at:a], d
        assert r["rest"] == rest + page[at:]
        if len([1 for _ in walk(page, "main")]) and page.lower().count("main") > 2:
            hard += 1
            assert r["main"] == page[mains[0][1] : mains[0][2]]
        nested = any("<div" in page[b:c] or "<!--" in page[b:c] for _, b, c, _ in divs)
        if nested:
            hard += 1
            assert r["divs"] == [page[b:c] for _, b, c, _ in divs]
    assert hard > 300


def test_nested_elements(one):
    page = "<body><nav><ul><nav>inner</nav>OUTERNAV</ul></nav><p>kept</p></body>"
    assert one(H.drop_boilerplate, page) == "<body><p>kept</p></body>"
    long = "word " * 30
    assert one(lambda h: H.main_content(h, 50), f"<main>a<main>b</main>{long}</main>") == f"a<main>b</main>{long}"
    inside = f"<div><div>{long}</div>tail</div>"
    assert one(lambda h: H.main_content(h, 50), f"<div role='main'>{inside}</div><div>no</div>") == inside
    assert one(lambda h: H.main_text(h, 20), f"<div id=\"content\">{inside}</div>") == f"{long.strip()}\ntail"
    cards = "<div class='event-card'><div><h3>One</h3></div><p>a</p></div><div class=\"event-card b\"><div>x</div></div>"
    assert one(H.event_cards, cards) == ["<div><h3>One</h3></div><p>a</p>", "<div>x</div>"]
    items = ("<ul><li>a<ul><li><a href='https://drive.google.com/file/d/X'>Deep</a></li></ul></li></ul>")
    assert [tuple(r) for r in one(H.labelled_pdf_links, items)] == [("deep", "https://drive.google.com/file/d/X")] * 2


def test_left_open_tags_make_no_element(one):
    assert one(lambda h: H.element(h, "main"), "<main>a<main>b</main>c") == "b"
    assert one(H.drop_boilerplate, "<nav>a<p>b</p>") == "<nav>a<p>b</p>"
    assert one(H.drop_boilerplate, "</nav>a<nav>b</nav>c</nav>") == "</nav>ac</nav>"
