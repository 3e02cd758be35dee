"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names: the defined results."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import LONG, PROSE
from corpusloom.llm import (
    codes, fingerprint, jaccard, language, licenses, mixing, neighbours, pieces, quality, ranking, substring, toxicity, urls,
)
from corpusloom.llm.common import sieve, stored
from corpusloom.llm.components import components


def by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


def test_jaccard(odd, none):
    got = by_id(jaccard.jaccard_components(odd, 4, 85))
    assert sum(map(len, got.values())) == 17
    assert [(r["n_shingles"], r["component_id"]) for i in (1, 2, 3) for r in got[i]] == [(0, 1), (0, 2), (0, 3)]
    assert {r["component_id"] for i in (4, 5) for r in got[i]} == {4} and got[6][0]["component_id"] == 6
    assert {r["component_id"] for i in (8, 9, 10) for r in got[i]} == {8}
    assert sorted(r["component_id"] or 0 for r in got[None]) == [0, 8]
    assert jaccard.jaccard_components(none, 4, 85).count() == 0
    kept = by_id(jaccard.one_of_each(odd, 4, 85))
    assert sorted(k for k in kept if k) == [1, 2, 3, 4, 6, 7, 8, 11, 12, 13]
    assert all(len(kept[k]) == 1 for k in kept if k) and [r["text"] for r in kept[None]] == [None]
    assert jaccard.one_of_each(odd, 4, 85).columns == odd.columns


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (300, 200), (300, 250)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200, 250: 200, 300: 200}


def test_language(odd, none):
    got = by_id(language.identified(odd, language.learned(odd)))
    assert [got[i][0]["lang_pred"] for i in (1, 2, 3, 11)] == ["und"] * 4
    assert got[4][0]["lang_pred"] == "en" and len(got[None]) == 2
    assert language.identified(none, language.learned(none)).count() == 0
    assert {r["lang_pred"] for r in language.identified(odd, language.learned(none)).collect()} == {"und"}


def test_fingerprint(odd, none):
    got = by_id(fingerprint.edited_fingerprints(odd))
    assert sum(map(len, got.values())) == 17
    assert [(r["n_chars"], r["fingerprint"]) for i in (1, 2, 3) for r in got[i]] == [(0, ""), (0, ""), (4, "")]
    assert got[1][0]["near_next"] == got[1][0]["near_edited"] == 1.0
    assert got[8][0]["fingerprint"] == got[9][0]["fingerprint"] != ""
    assert got[8][0]["near_next"] == 1.0 and got[7][0]["n_chars"] == len(LONG)
    half = len(PROSE) // 2
    assert got[8][0]["edited_sha256"] == hashlib.sha256((PROSE[: len(PROSE) - half] + PROSE[:half]).encode()).hexdigest()
    # after the last comes the first: a null id, whose text is empty
    assert got[13][0]["edited_sha256"] == hashlib.sha256(b"All rights").hexdigest()
    assert fingerprint.edited_fingerprints(none).count() == 0


def test_urls(spark):
    links = [
        (1, None), (2, ""), (3, "no scheme/en/"), (4, "http://WWW.Example.com/en/x?q#f"), (5, "https://a.net/es/1"),
        (6, "https://example.com/en/2"), (7, "https://example.com/de/2"), (8, "ftp://org/fr/3"), (8, "ftp://org/fr/3"),
        (None, "https://b.net/fr/é"), (9, "http://net"), (10, "http://example.com.evil.org/en/"), (11, "a://b://c.com/"),
    ]
    df = spark.createDataFrame([(*r, "h", "p", "t") for r in links], "page_id long, url string, host string, path string, html string")
    got = by_id(urls.judged(df, urls.RULES), "page_id")
    assert [tuple(got[i][0])[1:] for i in (1, 2, 3)] == [("", "", None, "allow")] * 3
    assert tuple(got[4][0])[1:] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[5][0]["rule"] == "net/es/" and got[6][0]["rule"] == "example.com/en/" and got[7][0]["rule"] == "com/"
    assert got[None][0]["rule"] == "net/fr/" and got[9][0]["rule"] is None and len(got[8]) == 2
    assert got[10][0]["rule"] is None and got[11][0]["host"] == "b:"
    assert urls.judged(df.limit(0), urls.RULES).count() == 0


def test_mixing(odd, none):
    got = by_id(mixing.mixed(odd, [3, 1, 2]))
    assert sum(map(len, got.values())) == 17
    assert all(r["taken"] == r["size"] == 0 for i in (1, 2, 3) for r in got[i])
    rows = [r for x in got.values() for r in x]
    for s in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1
    assert mixing.mixed(none, [3, 1, 2]).count() == 0
    out = mixing.mixed_documents(odd, [3, 1, 2])
    assert out.columns == odd.columns and mixing.mixed_documents(none, [3, 1, 2]).count() == 0
    words = out.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == sum(r["taken"] for r in rows)


def test_substring(odd, none):
    got = by_id(substring.removed_words(odd, 35))
    assert sum(map(len, got.values())) == 17
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(got[i][0])[1:] for i in (1, 2, 3)] == [(0, 0, empty)] * 3
    n = len(PROSE.split())
    assert all(tuple(r)[1:] == (n, n, empty) for i in (8, 9) for r in got[i])
    assert got[10][0]["n_removed"] == 0 and tuple(got[4][0])[1:] == (1, 0, hashlib.sha256(b"one").hexdigest())
    words = LONG.split()
    runs = {}
    for i in range(len(words) - 34):
        runs.setdefault(tuple(words[i : i + 35]), []).append(i)
    gone = {i + j for x in runs.values() if len(x) > 1 for i in x for j in range(35)}
    assert got[7][0]["n_removed"] == len(gone)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    assert got[7][0]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert substring.removed_words(none, 35).count() == 0
    texts = by_id(substring.without_repeats(odd, 35))
    assert texts[8][0]["text"] == "" and texts[3][0]["text"] == " \t\n " and texts[1][0]["text"] is None
    assert substring.without_repeats(odd, 35).columns == odd.columns


def test_mixing_overlaps(spark):
    """b holds nothing alone: its target is met with what it shares, and a and c move aside."""
    rows = [(i, "x " * 10, "a", ["a"]) for i in range(4)] + [(10 + i, "y " * 10, "a", ["b", "a", "b"]) for i in range(4)]
    rows += [(20 + i, "z " * 10, "c", ["c", "b"]) for i in range(2)] + [(30, "w " * 10, "c", None), (31, "v " * 10, "c", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, members array<string>")
    got = by_id(mixing.mixed(docs, [1, 2, 1], share=1.0, members="members"))
    # a, b and c hold 80, 60 and 40 words; the 120 there are by 1:2:1 are 30, 60 and 30
    assert {(r["source"], r["source_size"], r["target"]) for x in got.values() for r in x} == {("a", 80, 30.0), ("c", 40, 30.0)}
    taken = {i: x[0]["taken"] for i, x in got.items()}
    ab, bc, c = (sum(taken[i] for i in x) for x in ((10, 11, 12, 13), (20, 21), (30, 31)))
    # a keeps to its own, so b has all it shares with a; b and c repeat the 10 words they lack, no more
    assert sum(taken[i] for i in range(4)) == 30 and ab + bc + c == 90 and ab >= 40 and bc >= 20 and c >= 20
    out = mixing.mixed_documents(docs, [1, 2, 1], share=1.0, members="members")
    assert out.columns == docs.columns
    assert out.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == sum(taken.values())
    alone = {i: x[0]["taken"] for i, x in by_id(mixing.mixed(docs, [1, 2, 1], share=1.0)).items()}
    assert alone != taken


@pytest.mark.parametrize("window", [3, 20])
def test_substring_random(spark, window):
    r = np.random.default_rng(window)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 3, r.integers(0, 90))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {}
    for d, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = {(d, i + j) for x in seen.values() if len(x) > 1 for d, i in x for j in range(window)}
    for row in substring.removed_words(docs, window).collect():
        w = texts[row["doc_id"]].split()
        kept = [x for i, x in enumerate(w) if (row["doc_id"], i) not in gone]
        assert row["n_removed"] == len(w) - len(kept)
        assert row["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("window", [35, 50, 101])
def test_substring_one_word_edits(spark, window):
    """A passage in two documents that differs in one word, for every place of that word, against all windows."""
    r = np.random.default_rng(window)
    n, texts = 3 * window, []
    for place in range(n):
        passage = [f"p{x}" for x in r.integers(0, 10**9, n)]
        edited = [*passage[:place], f"edit{place}", *passage[place + 1 :]]
        texts += [" ".join(x) for x in (passage, edited)]
    once = [f"q{x}" for x in r.integers(0, 10**9, n)]  # one passage with an edit at every place
    texts += [" ".join([*once[:place], f"edit{place}", *once[place + 1 :]]) for place in range(n)]
    seen = {}
    for d, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - window + 1):
            seen.setdefault(" ".join(w[i : i + window]), []).append((d, i))
    gone = {(d, i + j) for x in seen.values() if len(x) > 1 for d, i in x for j in range(window)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substring.removed_words(docs, window).collect()
    assert len(rows) == len(texts)
    wrong = []
    for row in rows:
        kept = " ".join(x for i, x in enumerate(texts[row["doc_id"]].split()) if (row["doc_id"], i) not in gone)
        if row["kept_sha256"] != hashlib.sha256(kept.encode()).hexdigest():
            wrong.append(row["doc_id"])
    assert not wrong


def test_neighbours(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (None, [1.0, 0.0]), (100, [1.0, 1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, cell string")
    got = [tuple(r) for r in neighbours.nearest(df).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2)] and got[1][3] == pytest.approx(2**0.5)
    assert neighbours.nearest(df.limit(0)).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(300)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(same).filter("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(10)) and {r["score"] for r in got} == {0.0}


def test_pieces(odd, none):
    got = by_id(pieces.encoded(odd))
    assert sum(map(len, got.values())) == 17 and all(r["lossless"] for x in got.values() for r in x)
    assert got[1][0]["ids"] is None and got[1][0]["decoded_sha256"] is None and got[2][0]["ids"] == []
    assert got[8][0]["ids"] == got[8][1]["ids"]
    assert pieces.encoded(none).count() == 0


def test_quality(odd, none, labels):
    got = by_id(quality.quality_scores(odd, labels))
    assert sum(map(len, got.values())) == 17
    assert got[1][0]["score"] == got[2][0]["score"] and not got[None][0]["held_out"]
    assert {r["score"] for r in quality.quality_scores(odd, labels.filter("quality = 1")).collect()} != {0.5}
    assert {r["score"] for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.without_rejected(odd, labels.limit(0)).count() == 17
    assert quality.without_rejected(odd, labels).columns == odd.columns


def test_licenses(odd, none):
    got = by_id(licenses.scanned(odd))
    assert sum(map(len, got.values())) == 17
    assert tuple(got[13][0])[1:3] == ("all-rights-reserved", 1)
    assert all(tuple(got[i][0])[1:] == ("", 0, None, 0.0) for i in (1, 2, 3, 7))
    assert licenses.scanned(none).count() == 0


def test_license_bands_reach_the_least_likeness():
    """A window full of other notices is as unlike a template as a match can be."""
    grams = {k: {tuple(w[i : i + 2]) for i in range(len(w) - 1)} for k, v in licenses.TEMPLATES.items()
             if (w := re.findall("[a-z0-9]+", v.lower()))}
    words = {k: len(re.findall("[a-z0-9]+", v.lower())) for k, v in licenses.TEMPLATES.items()}
    for k, g in grams.items():
        c = (words[k] - 1).bit_length()
        held, must = 2 ** (c + 1) - 1, -(-len(g) * 4 // 5)
        least = must / (len(g) + held - must)
        assert licenses.least_likeness(len(g), c) == pytest.approx(least)
        assert (1 - least) ** licenses.bands(licenses.least_likeness(len(g), c)) <= licenses.MISS


def test_licenses_dense(spark):
    """Footers of many notices, whose windows hold little of any one of them."""
    r = np.random.default_rng(5)
    notices = sorted(licenses.TEMPLATES.values(), key=len)[:6]
    texts = [" ".join(notices[i] for i in r.integers(0, len(notices), 6)) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {k: v for k, v in licenses.TEMPLATES.items() if v in notices}
    for row in licenses.scanned(docs).collect():
        assert {k for k, v in whole.items() if v in texts[row["doc_id"]]} <= set(row["licenses"].split(","))


def test_pipeline_stages(spark, labels):
    """Every stage works on what the one before kept, and its decisions take effect."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf))
        kept[name] = (before, docs)
        if name != "sentencepiece":
            assert docs.columns == before.columns
    a, b = kept["quality_classifier"]
    said = quality.quality_scores(a, spark.read.parquet(f"{sf}/labels.parquet"))
    assert {r[0] for r in b.select("doc_id").collect()} == {r[0] for r in said.filter("predicted = 1").select("doc_id").collect()}
    a, b = kept["ngram_jaccard_join"]
    groups = jaccard.jaccard_components(a)
    assert {r[0] for r in b.select("doc_id").collect()} == {r[0] for r in groups.select("component_id").collect()}
    a, b = kept["substring_dedup"]
    assert b.count() == a.count()
    shas = {r["doc_id"]: r for r in substring.removed_words(a, 50).collect()}
    for r in b.collect():
        words = " ".join(r["text"].encode().decode().split(" "))
        assert shas[r["doc_id"]]["n_removed"] == 0 or hashlib.sha256(words.encode()).hexdigest() == shas[r["doc_id"]]["kept_sha256"]
    a, b = kept["source_mixing"]
    taken = mixing.mixed(a, [3, 1, 2]).agg(F.sum("taken")).first()[0]
    assert taken == b.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    a, b = kept["sentencepiece"]
    assert b.count() == a.count() and b.filter("not lossless").count() == 0


@pytest.mark.parametrize(("words", "percent"), [(1, 60), (2, 85)])
def test_jaccard_random(spark, words, percent):
    """Many near copies around the threshold, against all pairs."""
    r = np.random.default_rng(percent)
    bases = [r.integers(0, 400, r.integers(3, 120)) for _ in range(12)]
    texts = []
    for _ in range(240):
        base = bases[r.integers(0, len(bases))].copy()
        hit = r.random(len(base)) < r.choice([0.0, 0.03, 0.1, 0.3])
        base[hit] = r.integers(0, 400, hit.sum())
        texts.append(" ".join(f"w{x}" for x in base[: len(base) - r.integers(0, 3)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        w = t.split()
        k = min(words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    low = list(range(len(sets)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                low[b] = a
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"])
           for x in jaccard.jaccard_components(docs, words, percent).collect()}
    assert got == {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_links_of_rows_without_an_id(spark):
    near = PROSE + " and this ends it"
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(None, PROSE), (None, near), (2, near + " now"), (None, other), (None, other), (None, other + " more"), (None, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _ref string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in jaccard.jaccard_components(df, 4, 85).collect() if r["component_id"])
    assert got == [("2", 2), ("None", 2), ("None", 2)]
    kept = sorted(str((r["doc_id"], (r["text"] or "")[:5])) for r in jaccard.one_of_each(df, 4, 85).collect())
    assert kept == ["(2, 'the q')", "(None, '')", "(None, 'other')"]


def test_neighbours_count_repeated_rows_once(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))]
    twin = (1, [x + 1e-3 for x in vectors[0][1]])
    rows = vectors[:1] + vectors[2:] + [twin] * 12
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in neighbours.nearest(df).collect()}
    x = np.array([v for _, v in vectors])
    x[1] = twin[1]
    want = [int(i) for i in np.argsort(((x - x[0]) ** 2).sum(1), kind="stable") if i != 0][:10]
    assert [got[0, r] for r in range(1, 11)] == want


def test_mined_rules_of_any_length(spark):
    listed = [(i, f"https://example.com/en/x{i}?a=1&b=2") for i in range(20)]
    for k, u in enumerate(("en/x?a=1", "en/x?b=1", "en/?a=1&b=2", "x?a=1&b=2")):
        listed += [(100 * (k + 1) + i, f"https://f.com/{u}") for i in range(20)]
    df = spark.createDataFrame([*listed, (9, "https://site.org/en/x3?a=1&b=2")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judged(df, urls.RULES).collect()}
    assert got[9] == "block" and got[100] == "allow"


def test_mixing_without_ids_is_repeatable(spark):
    texts = [f"w{i} a b c" for i in range(8)]
    schema = "doc_id long, text string, source string"
    picks = []
    for order in (texts, texts[::-1]):
        df = spark.createDataFrame([(None, t, "s") for t in order], schema).coalesce(1)
        picks.append(sorted(r["text"] for r in mixing.mixed_documents(df, [1], share=0.5).collect()))
    assert picks[0] == picks[1] and len(picks[0]) == 4


def test_toxicity(spark, odd, none, labels):
    marks = labels.select("doc_id", "quality", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = by_id(toxicity.toxicity_scores(odd, marks))
    assert sum(map(len, got.values())) == 17 and all(0 <= r["score"] <= 1 for x in got.values() for r in x)
    assert got[1][0]["windows"] == got[2][0]["windows"] == 1 and got[7][0]["windows"] == -(-(len(LONG) - 16) // 48)
    assert len({r["score"] for i in (8, 9) for r in got[i]}) == 1 and not got[None][0]["held_out"]
    assert toxicity.toxicity_scores(none, marks).count() == 0
    # without a label 1 among the rows to learn from, every score is one smoothed share
    plain = toxicity.toxicity_scores(odd, labels.filter("toxic = 0")).collect()
    assert len({r["score"] for r in plain}) == 1 and {r["windows"] for r in plain} == {None}


def test_windows_cover_every_byte():
    lengths = np.array([0, 1, 63, 64, 65, 112, 113, 1000])
    at, length, first = toxicity.windows_of(lengths)
    for i, n in enumerate(lengths):
        part = slice(first[i], first[i + 1] if i + 1 < len(first) else len(at))
        seen = np.zeros(lengths.sum() + 1, bool)
        for a, k in zip(at[part], length[part], strict=True):
            assert k <= toxicity.WINDOW
            seen[a : a + k] = True
        assert seen.sum() == n and seen[lengths[:i].sum() : lengths[: i + 1].sum()].all()


def brute_codes(vectors, rounds=codes.ROUNDS):
    x = np.floor(1024 * np.array([v for _, v, _ in vectors])).astype(np.int64)
    order = sorted(range(len(vectors)), key=lambda i: vectors[i][0])
    out, error = np.zeros((len(x), 4), int), np.zeros(len(x), np.int64)
    for p, (a, z) in enumerate(codes.bounds(x.shape[1])):
        part = x[:, a:z]
        book = part[order[:256]].copy()
        for step in range(rounds + 1):
            d = ((part[:, None] - book[None]) ** 2).sum(2)
            own = d.argmin(1)
            if step < rounds:
                for e in set(own.tolist()):
                    book[e] = part[own == e].sum(0) // (own == e).sum()
        out[:, p] = own
        error += d.min(1)
    return ["".join(f"{c:02x}" for c in r) for r in out], error


@pytest.mark.parametrize("width", [8, 10, 3])
def test_codes(spark, width):
    rng = np.random.default_rng(width)
    spots = rng.integers(-3, 4, size=(40, width)) / 64
    vectors = [(i, (spots[rng.integers(40)] + rng.integers(-1, 2, size=width) / 1024).tolist(), [None, 1, 2][i % 3]) for i in range(700)]
    bad = [(900, None, 1), (901, [None] * width, 1), (902, [float("nan")] * width, 2), (903, [float("inf")] * width, 2)]
    df = spark.createDataFrame([(*r, "c") for r in vectors + bad], "vec_id long, embedding array<double>, label int, code string")
    got = {r["vec_id"]: r for r in codes.coded(df).collect()}
    code, error = brute_codes(vectors)
    assert sorted(got) == list(range(700)) and [got[i]["code"] for i in range(700)] == code
    assert [got[i]["error"] for i in range(700)] == error.tolist()
    for label in (None, 1, 2):
        mine = [i for i, _, k in vectors if k == label]
        assert {got[i]["label_error"] for i in mine} == {int(error[mine].sum())}
    assert len({r["codebooks_sha256"] for r in got.values()}) == 1


def test_codes_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert codes.coded(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [0.0] * 4, 1), (1, [0.0] * 4, 1), (None, [1.0, 2.0, 3.0, 4.0], None), (2, [], 5), (3, [1e30] * 8, 5)]
    got = codes.coded(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["code"], r["error"]) for r in got) == [
        (0, "02020202", 0), (1, "00000000", 0), (1, "00000000", 0), (2, "00000000", 0), (3, "00000000", 0)]


def test_ball_kmeans_is_exact_and_skips_work():
    rng = np.random.default_rng(5)
    entries = rng.integers(-200, 200, size=(64, 4))
    entries[10] = entries[3]  # a tie
    x = np.concatenate([entries[rng.integers(64, size=3000)] + rng.integers(-9, 10, size=(3000, 4)), rng.integers(-300, 300, size=(500, 4))])
    own = ((x[:, None] - rng.permutation(entries)[None]) ** 2).sum(2).argmin(1)
    radius = np.array([int(np.ceil(np.sqrt(max([0, *((x[own == e] - entries[e]) ** 2).sum(1)])))) for e in range(64)])
    best, far, work = codes.Book(entries, radius).assigned(x, own)
    d = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (best == d.argmin(1)).all() and (far == d.min(1)).all()
    best, _, again = codes.Book(entries, radius).assigned(x, best)
    assert (best == d.argmin(1)).all() and again < len(x) * 64 / 4 and again < work
    big = np.array([[1 << 24, -(1 << 24)], [0, 1]])
    assert codes.squared(big, big).tolist() == [[0, (1 << 48) + ((1 << 24) + 1) ** 2], [(1 << 48) + ((1 << 24) + 1) ** 2, 0]]


def brute_ranks(docs, items, k=10):
    import math
    from collections import Counter

    def terms(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, t in items:
        scored = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m))
                    for x, q in Counter(terms(t)).items() if x in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_ranking(spark, odd, none):
    rng = np.random.default_rng(2)
    words = [f"w{int(x)}" for x in rng.zipf(1.3, 20_000) % 400] + ["É", "\xa0x", "Ab-cd", "ab_CD"]
    docs = [(int(i), " ".join(rng.choice(words, int(rng.integers(0, 60))))) for i in rng.permutation(600)]
    docs += [(None, "w1 w2 rare"), (5, docs[0][1]), (7, None), (8, "--"), (9, "w3 " * 3000)]
    items = [(int(i), " ".join(rng.choice(words, int(rng.integers(1, 12))))) for i in range(25)] + [(90, None), (91, "-"), (92, "nowhere"), (None, "rare w1")]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, row int")
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, item int")
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranking.ranked(d, q).collect()), key=str)
    assert got == brute_ranks(docs, items)
    assert ranking.ranked(none, q).count() == 0 and ranking.ranked(d, q.limit(0)).count() == 0
    assert ranking.ranked(odd, q).count() >= 0


def test_join_leaves_the_session_as_it_was(spark, none):
    from corpusloom.llm.common import FREED_SHUFFLES, SMALL_BATCHES

    keys = [*FREED_SHUFFLES, *SMALL_BATCHES]
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[1], "7777")
    jaccard.jaccard_components(none).count()
    assert spark.conf.get(keys[1]) == "7777" and spark.conf.get(keys[0], None) == before[keys[0]]
    spark.conf.unset(keys[1]) if before[keys[1]] is None else spark.conf.set(keys[1], before[keys[1]])


def test_tile_pairs_are_told_once():
    import pandas as pd

    rows = pd.DataFrame({"t": [1, 1, 1], "id": [1, 2, 3], "n": [40, 40, 41], "home": True, "label": [1, 2, 3], "block": 0, "cross": False})
    rows["bits"] = [jaccard.bitmap(np.arange(n, dtype=np.uint64), 6) for n in rows["n"]]
    seen = set()
    assert jaccard.tile_pairs(rows, 85, seen).to_numpy().tolist() == [[1, 2], [1, 3], [2, 3]]
    assert len(jaccard.tile_pairs(rows, 85, seen)) == 0 and len(seen) == 3


def test_tile_pairs_by_place():
    import pandas as pd

    rows = pd.DataFrame({"t": 1, "id": [1, 2, 3], "n": 40, "home": True, "label": [1, 2, 3], "block": 0, "cross": False, "pos": [0, 2, 5]})
    rows["bits"] = [jaccard.bitmap(np.arange(40, dtype=np.uint64), 6)] * 3
    # 15 / 185 of 80 is 6: sets 2 and 3 have 7 elements before the shared one that the other has not
    assert jaccard.tile_pairs(rows, 85, set()).to_numpy().tolist() == [[1, 2], [1, 3]]


def test_a_set_is_compared_once_for_many_tiles(spark, monkeypatch):
    r = np.random.default_rng(3)
    base, texts = [f"w{i}" for i in range(200)], []
    for d in range(30):
        words = list(base)
        for k in r.choice(200, 4, replace=False):
            words[k] = f"d{d}k{k}"
        texts.append(" ".join(words))
    tables = {}

    def counted(df, by=None):
        out = stored(df, by)
        tables[frozenset(df.columns)] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.jaccard_components(docs, 4, 85).collect()
    assert sorted(x["component_id"] for x in got) == list(range(30))
    tiles = tables[frozenset(["t", "id", "n", "home", "pos"])]
    sets = tables[frozenset(["id", "lo", "n", "label", "t", "home", "pos"])]
    assert tiles > 12 * 30 and sets < 4 * 30


def test_a_sieve_takes_no_python_worker(spark):
    rows = spark.range(2_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("text").alias("w"))
    wanted = spark.createDataFrame([(5,), (5,), (70,), (None,), (1_999,), (9_999,)], "k long")
    found = sieve(rows, "k", wanted)
    assert found.columns == ["k", "w"]
    got = [r["k"] for r in found.collect()]
    assert {None, 5, 70, 1_999} <= set(got) and len(got) == len(set(got)) < 20
    assert sieve(rows, "k", wanted.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_quality_portions_give_one_result(monkeypatch):
    net = quality.Network(1)
    texts = [(f"some text {i} " * (i * 300)).encode() for i in range(60)]
    small = net.scores(texts)
    monkeypatch.setattr(quality, "BATCH_BYTES", 1 << 20)
    assert max(map(len, texts)) > 1 << 17 and np.allclose(small, net.scores(texts), atol=2e-5)
