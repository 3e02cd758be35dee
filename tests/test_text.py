import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import markdown as M
from corpusloom.functions import text as X
from corpusloom.rules import HS, PY_WS, WS


def test_whitespace_is_pythons():
    assert all(c.isspace() for c in PY_WS)
    assert {c for n in range(0x10000) if (c := chr(n)).isspace()} == set(PY_WS)


@pytest.mark.parametrize("raw", ["  a b\u00a0\u3000\n", "\u2003x", "", " \n ", "no"])
def test_strip(one, raw):
    assert one(X.strip, raw) == raw.strip()


@pytest.mark.parametrize("raw", ["they're bill's friends", "o'neil-smith 3rd", "ßeta ŌTAKI", "", "x1y"])
def test_title_case(one, raw):
    assert one(X.title_case, raw) == raw.title()


def test_slugs(one):
    assert one(X.title_slug, " Hello,  World!-- Ünï " + "x" * 100).startswith("hello-world-n-xxx")
    assert len(one(X.title_slug, "a" * 100)) == 80
    assert one(X.doc_type_slug, "  Citizen's Voice -- 2 - ") == "citizens-voice-2"
    assert one(X.name_slug, "Jo/Ann  O'Hara-") == "jo-ann-ohara"
    assert one(X.label_slug, "Our Rules (v2) -") == "our-rules-v2"
    assert one(X.media_slug, "Café_Talk: Ep. 4!") == "café-talk-ep-4"
    assert one(X.path_slug, "/candidate-daniel-eb") == "daniel-eb"
    assert one(X.path_slug, "/meet/") == "meet"


@pytest.mark.parametrize("name, slug", [
    ("Brand_Abundant Energy_Policy Overview.pdf", "abundant-energy"),
    ("_migrated_Brand_Policy_Healthy Oceans.pdf", "healthy-oceans"),
    ("1aBcDeFgHiJkLmNoPqRsTuVwXyZ0123456789.pdf", None),
    ("_x.pdf", None),
    ("123.pdf", None),
])
def test_slug_from_filename(one, name, slug):
    assert one(X.slug_from_filename, name) == slug


@pytest.mark.parametrize("raw, day", [
    ("Mon, 08 Jun 2026 10:00:00 +1200", "2026-06-08"),
    ("Mon, 8 Jun 2026 23:59:59 -0930", "2026-06-08"),
    ("Mon, 31 Jun 2026 10:00:00 +1200", ""),
    ("08 Jun 2026 10:00:00 +1200", ""),
    ("Mon, 08 Jun 2026 25:00:00 +1200", ""),
    ("", ""),
])
def test_rfc822(one, raw, day):
    assert one(X.rfc822_date, raw) == day


@pytest.mark.parametrize("raw, day", [
    ("Jun 8, 2026", "2026-06-08"), ("June 18, 2026", "2026-06-18"), ("8 June", ""),
])
def test_display_date(one, raw, day):
    assert one(X.display_date, raw) == day


def test_fixed_rounds_like_c(spark):
    rng = random.Random(3)
    values = [k / 10000 * 100 for k in range(0, 10001, 5)] + [rng.random() * 100 for _ in range(500)]
    values += [0.0, 100.0, 0.05, 0.125, 12.35]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(X.fixed(F.col("v"), 1)).collect()]
    assert got == [f"{v:.1f}" for v in values]
    df = spark.createDataFrame([(v / 100,) for v in values], "v double")
    got = [r[0] for r in df.select(X.fixed(F.col("v"), 3)).collect()]
    assert got == [f"{v / 100:.3f}" for v in values]


@pytest.mark.parametrize("url, name", [
    ("https://x.org/a/b.PDF?x=1", "b.PDF"), ("https://x.org/a/b", "b.pdf"),
    ("https://x.org", "download.pdf"), ("https://x.org/#f", "download.pdf"),
    ("https://x.org/a/", "a.pdf"),
])
def test_filename_from_url(one, url, name):
    assert one(X.filename_from_url, url) == name


# --- markdown ---------------------------------------------------------------

CONTENTS = "# T\n\n## **Contents**\n\n|1.|Aims 3|\n|2.|Ends 4|\n\n## **1. Aims**\n\nbody\n"


def test_contents_removed_once_and_idempotent(one):
    cut = one(lambda c: M.strip_contents_section(c)[0], CONTENTS)
    assert cut == "# T\n\n\n## **1. Aims**\n\nbody\n"
    assert one(lambda c: M.strip_contents_section(c)[0], cut) == cut
    assert one(lambda c: M.strip_contents_section(c)[1], CONTENTS) is True
    assert one(lambda c: M.strip_contents_section(c)[1], cut) is False


def test_contents_to_the_end(one):
    assert one(lambda c: M.strip_contents_section(c)[0], "a\n## **Contents**\n|1|2|\n") == "a\n"
    whole = "a\n## **Contents**\n|1|2|"
    assert one(lambda c: M.strip_contents_section(c)[0], whole) == whole


def test_contents_matches_the_pattern_it_stands_for(one):
    pattern = re.compile(r"## \*\*Contents\*\*\s*\n(?:.*\n)*?(?=\n## |\Z)")
    rng = random.Random(5)
    bits = ["## **Contents**", "## A", "x", "", " ", "|1|"]
    for _ in range(60):
        text = "\n".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        assert one(lambda c: M.strip_contents_section(c)[0], text) == pattern.sub("", text, count=1)


def test_contents_of_a_long_document(one):
    text = "## **Contents**\n" + "|x|y|\n" * 50_000 + "\n## Next"
    assert one(lambda c: M.strip_contents_section(c)[0], text) == "\n## Next"


def test_blockquote_and_images(one):
    assert one(M.strip_metadata_blockquote, "> **URL**: u\n>  **Scraped**: s\n\n \nBody\n> q") == "Body\n> q"
    assert one(M.strip_metadata_blockquote, "> **URL**: u\n\n") == ""
    assert one(M.strip_metadata_blockquote, "\n\nx") == "x"
    text = "a\n\n![x](y)\n\n [![b](c)](d) \n\nsee ![in](line) text"
    assert one(M.strip_image_lines, text) == "a\n\nsee ![in](line) text"


def test_cuts(one):
    assert one(M.strip_footer_sections, "a \n\n### Check out more policies\nx\n## Get Involved") == "a"
    assert one(M.strip_footer_sections, "a\n##Get Involved") == "a"
    assert one(M.remove_close_carousel, "a\nclose (x) b") == "a"
    assert one(M.remove_close_carousel, "a\nPrevious \n Next\n") == "a"
    assert one(M.remove_media_contact, "a\n##### Media Contact\nb") == "a"


def test_duplicate_h1(one):
    text = "# A (b) \\E\n# A (b) \\E\n\nx\n# A (b) \\E\n"
    assert one(M.strip_duplicate_h1, text, " A (b) \\E ") == "x\n# A (b) \\E\n"
    assert one(M.strip_duplicate_h1, "x\n# A\n", "A") == "x\n# A\n"


def test_clean_body_without_title(one):
    assert one(lambda b, t: M.clean_body(b, t), "# A\n\nx", "") == "# A\n\nx"


def test_metadata_fields(one):
    text = "**Title**: A\n  **Date**: 2026 \n**Foo**: x\n**Title**: B\n**When**: \n **Venue**: \nbody **URL**: u"
    assert one(M.metadata_fields, text) == {"Title": "B", "Date": "2026", "When": ""}
    assert one(M.without_metadata_fields, text) == "**Foo**: x\n **Venue**: \nbody **URL**: u"
    assert one(M.metadata_fields, "plain") == {}


def test_pdf_table(one):
    text = "# T\n| Field | Value |\n|-------|-------|\n| Date | May |\n| Source | `a.pdf` |\n| Date | June |"
    meta = one(M.pdf_table_meta, text)
    assert (meta["Date"], meta["Source"]) == ("June", "a.pdf")
    assert one(lambda c: M.pdf_table_field(c, "Date"), text) == "June"
    assert one(lambda c: M.pdf_table_field(c, "Nope"), text) is None
    assert one(M.strip_pdf_metadata_table, text + "\n\n**Tax**\n\n# H1\nbody") == "\n\n\nbody".lstrip("\n")


def test_frontmatter(one):
    got = one(lambda a, b: M.frontmatter([("t", a), ("e", F.lit("")), ("n", F.lit(None).cast("string")),
                                          ("l", F.array(b, b)), ("z", F.array().cast("array<string>"))],
                                         ("l", "z")), 'a "q" \\ \n', "v")
    assert got == '---\nt: "a \\"q\\" \\\\ \\n"\nl: ["v", "v"]\n---'


@pytest.mark.parametrize("text, body", [
    ("---\na: 1\n---\nb\n---\nc", "b\n---\nc"), ("plain", "plain"), ("---\nopen", "---\nopen"), ("", ""),
])
def test_strip_frontmatter(one, text, body):
    assert one(M.strip_frontmatter, text) == body


def test_doc_title(one):
    assert one(M.doc_title, "---\ntitle: 'My Title' \n---\n# Other", "s") == "My Title"
    assert one(M.doc_title, "x\n#  Head \ny", "s") == "Head"
    assert one(M.doc_title, "x", "s") == "s"


def test_profile_markdown(one):
    text = "#### AREA\n\n# N\n\n#### AREA\n\n# N\n\nBio [Email: [a@b]](/cdn-cgi/l/email-protection#x)\n\n\n\n## DONATE now\nx"
    assert one(M.clean_profile_markdown, text) == "#### AREA\n\n# N\n\nBio"
    assert one(M.clean_profile_markdown, "## Donated items\nx") == "## Donated items\nx"


def test_redundant_headings(one):
    md = "#### AREA\n\n# Jo (X)\n\na\n\n# Jo (X)\n\n## **Jo (X) (Dr)**\n\n## About us\n"
    assert one(M.strip_redundant_headings, md, "Jo (X)", "Area") == "# Jo (X)\n\na\n\n## About\n## About us"
    assert one(M.strip_redundant_headings, "# A\n\n# A\n", "", "") == "# A\n\n# A"


def test_glyphs(one):
    assert one(M.strip_glyphs, "O\u200bff\ufeffi\u00adcer o\ue123icer \ue123 \ufffd") == "Officer oicer \ue123 "


def test_pdf_body(one):
    raw = ("Date **May** Policy **P**\n**==> picture [1 x 2] intentionally omitted <==**\n**Page 3**\n"
           "Example Org  Tax  Page 4\nText \t\n\n\n\nDate of **x**\n")
    assert one(M.clean_pdf_body, raw) == "Text\n\nDate of **x**"
    assert one(M.pdf_header, raw) == {"date": "May", "policy": "P"}


def test_summary(one):
    assert one(lambda c: M.summary(c, 3), "## Big *news*\n> [go](http://x) - there") == "Big news go…"
    assert one(lambda c: M.summary(c, 3), "one **two** three") == "one two three"
    assert one(lambda c: M.summary(c, 3), "") == ""


def test_absolutize(one):
    assert one(lambda c: M.absolutize_links(c, "https://x.org/$1/")[0], "[a](/b) [c](d)") == "[a](https://x.org/$1/b) [c](d)"


@pytest.mark.parametrize("fn", [
    M.strip_metadata_blockquote, M.strip_image_lines, M.collapse_blank_runs, M.strip_footer_sections,
    M.strip_glyphs, M.clean_profile_markdown, M.clean_pdf_body,
])
def test_idempotent(one, fn):
    text = "> **URL**: u\n\n# A\n\n\n\n![i](j)\nx\n## Get Involved\ny"
    once = one(fn, text)
    assert one(fn, once) == once


def test_section_base(one):
    assert one(M.section_base, "Base \n\n---\n\n# Old\nx\n\n---\n\n# Older") == "Base"
    assert one(M.section_base, "Base\n\n---\n\ntext") == "Base\n\n---\n\ntext"


def test_age_and_label(one):
    for s, age in ((59, "59s"), (60, "1m"), (3599, "59m"), (3600, "1h0m"), (90061, "25h1m")):
        assert one(lambda c: X.format_age(c.cast("bigint")), str(s)) == age
    assert one(lambda t: X.video_label(t, F.lit(61), F.lit("shorts")), "T") == "T  [1:01] [short]"
    assert one(lambda t: X.video_label(t, F.lit(None).cast("int"), F.lit("videos")), "T") == "T"


def test_patterns_are_ascii():
    assert WS.isascii() and HS.isascii()


def test_pattern_only_where_its_text_is_held(one):
    def marked(b):
        return M.where_held(b, ("x", "yy"), lambda c: F.concat(c, F.lit("!")))

    assert [one(marked, t) for t in ("ax", "yyb", "yb", "", None)] == ["ax!", "yyb!", "yb", "", None]


@pytest.mark.parametrize("end", ["", "a", "~", "!", "é", " ", "\n \t", "a\xa0", "　", "\x85", "\x1f", "\x7f", "𝄞", "𝄞 "])
def test_rstrip_long(one, end):
    for text in ("", "b c"):
        assert one(X.rstrip_long, text + end) == (text + end).rstrip(PY_WS)


FIELD = r"(?:\*\*(?:Title|Date)\*\*:.|\s*\*\*(?:Title|Date)\*\*:.*\S)"


@pytest.mark.parametrize("body", [
    "", "\n", "a", "a\n\nb\n", "**Title**: x", "**Title**: x\n", "**Title**:\n\nb", "**Title**: é\n**Date**: 𝄞\n\nb **: c\n\nd é\n",
    "**Title**: x\n**Date**: y", "\n**Title**: x", "a\n \x85**Date**:  y \xa0\n**Note**: z\n", "**Title**: a **:b\n**Title**: 2\nc",
    "b\n**: c", "**:", "x **Title**: y\n**Date**: ",
])
def test_fields_end_at_the_last_mark(one, body):
    found = [x for x in body.split("\n") if re.match(FIELD, x)]
    pairs = {x.split("**", 2)[1]: x.split("**:", 1)[1].strip(PY_WS) for x in found}
    assert one(lambda b: M.metadata_fields(b, ("Title", "Date")), body) == pairs
    rest = "\n".join(x for x in body.split("\n") if x not in found)
    assert one(lambda b: M.without_metadata_fields(b, ("Title", "Date")), body) == rest


def test_cut_at_keeps_what_precedes_the_first_match(one):
    for text in ("a\nb CUT c\nCUT", "CUT", "", "a\r\n\x85", "a CU\nT", "𝄞CUT\n\n"):
        assert one(lambda b: M.cut_at(b, "CUT|X+Y"), text) == text.split("CUT")[0]
