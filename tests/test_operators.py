import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import find as FD
from corpusloom.operators import normalise as N
from corpusloom.operators import registry as R
from corpusloom.operators import reports as G
from corpusloom.operators import scale
from corpusloom.operators.scale import down, first_by, lookup_join, nth_rows, numbered, up
from corpusloom.operators.snapshots import snapshot_stats, with_freshness


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; some keys are null."""
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randint(0, 200)}") for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, k string")


def test_lookup_join_with_hot_keys(spark, skewed):
    rows, fact = skewed
    dim_rows = [("hot", 1), *[(f"k{i}", i) for i in range(0, 200, 2)]]
    dim = spark.createDataFrame(dim_rows, "k string, v int")
    table = dict(dim_rows)
    for how, want in {
        "left": [(i, k, table.get(k)) for i, k in rows],
        "inner": [(i, k, table[k]) for i, k in rows if k in table],
        "left_semi": [(i, k) for i, k in rows if k in table],
        "left_anti": [(i, k) for i, k in rows if k not in table],
    }.items():
        got = lookup_join(fact, dim, ["k"], how).collect()
        assert Counter(map(tuple, got)) == Counter(want), how


def test_lookup_join_splits_hot_partitions(spark):
    """One key with half of the rows: adaptive execution splits its partition."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 2 = 0, 0, id) AS k", "uuid() AS pad")
        joined = lookup_join(fact, spark.range(1000).selectExpr("id AS k", "id AS v"), ["k"])
        assert joined.filter("v is not null").count() == 100_500
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_numbered_across_partitions(skewed, spark):
    rows, fact = skewed
    keyed = fact.fillna({"k": "none"})
    got = numbered(keyed, ["k"], ["id"], F.lit(2)).collect()
    want, seen = {}, defaultdict(int)
    for i, k in sorted((i, k or "none") for i, k in rows):
        seen[k] += 1
        want[i] = seen[k]
    assert {r["id"]: r["n"] for r in got} == want
    assert all(r["before"] == 2 * (r["n"] - 1) for r in got)
    whole = numbered(keyed, [], [down("id")]).collect()
    assert {r["id"]: r["n"] for r in whole} == {i: 3000 - i for i, _ in rows}


def test_numbered_over_pieces(skewed, spark):
    rows, fact = skewed
    keyed = fact.fillna({"k": "none"})
    whole = numbered(keyed, ["k"], [down("id")], F.lit(1))
    cut = numbered(keyed, ["k"], [down("id")], F.lit(1), piece_rows=60)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert "_pid" not in cut.columns and "checkpoint" not in cut._jdf.queryExecution().toString().lower()


def test_nth_rows_by_counts(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "a", "b", "é", "z" * 5]), rng.choice([None, 1.5, -2.0, 7.0])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s string, v double")
    order = [down("s"), up("v"), down("id")]
    want = [r["id"] for r in df.orderBy(F.desc("s"), F.asc("v"), F.desc("id")).collect()]
    for offset, limit in ((0, 7), (1500, 10), (2995, 20), (3000, 5), (700, 900)):
        got = nth_rows(df, order, offset, limit, small=50)
        assert [r["id"] for r in got.collect()] == want[offset : offset + limit]
    same = spark.range(500).withColumn("v", F.lit(1))
    assert nth_rows(same, [up("v"), up("id")], 250, 3, small=10).select("id").collect() == [(250,), (251,), (252,)]
    plan = nth_rows(df, order, 1500, 10, small=50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert nth_rows(df.limit(0), order, 0, 5).count() == 0


def test_first_by(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 1)], "id int, k string, o int")
    assert {tuple(r) for r in first_by(df, ["k"], F.col("o")).collect()} == {(2, "a", 3), (3, "b", 1)}
    assert {tuple(r) for r in first_by(df, ["k"], F.col("o"), last=True).collect()} == {(1, "a", 5), (3, "b", 1)}


def test_sections_are_found_by_search_and_items_count_once(spark):
    files = [("p0", f"pdf-{i:02d}.md", f"# T\n| a | b |\n\nbody {i}" + " needle" * (i == 19)) for i in range(20)]
    pdfs = spark.createDataFrame(files, "policy_slug string, file string, raw string")
    sections = N.pdf_sections(pdfs)
    assert sections.count() == 20 and N.policy_with_pdf_text(
        spark.createDataFrame([("p0", "Base"), ("p9", "Alone")], "slug string, body string"), sections).count() == 21
    rows = [("p0", "policy", "T", ""), ("p9", "policy", "U", "x")]
    items = schemas.conform(spark.createDataFrame(rows, "slug string, content_type string, title string, body string"))
    page = FD.find_policies(items, sections, query="needle")
    assert [r["slug"] for r in page.items.collect()] == ["p0"] and page.envelope.first()["total"] == 1
    assert FD.find_policies(items, sections, query="missing").envelope.first()["total"] == 0
    assert G.item_counts(items).first()["items"] == 2


def test_merge_keeps_old_and_unknown(spark):
    old = spark.createDataFrame([("a", "1", "h", {"x": "o", "y": "o"}), ("b", "2", "h", None)],
                                "k string, v string, html string, extra map<string,string>")
    new = spark.createDataFrame([("a", "", {"x": "n"}), ("c", "3", {})], "k string, v string, extra map<string,string>")
    got = {r["k"]: r.asDict() for r in N.merge_meta(old, new, ["k"], "extra").collect()}
    assert got["a"] == {"k": "a", "v": "", "html": "h", "extra": {"x": "n", "y": "o"}}
    assert got["b"]["html"] == "h" and got["c"] == {"k": "c", "v": "3", "html": None, "extra": {}}


def test_generated_roster_is_not_a_member(spark):
    raw = spark.createDataFrame([("team", "# Index"), ("jo", "**Role**: X\n\nhi")], "slug string, raw string")
    got = N.clean_team(raw, "t").collect()
    assert [(r["slug"], r["name"], r["role"]) for r in got] == [("jo", "Jo", "X")]


def brute_downloads(links, registry):
    reg = {k: (f, m) for k, f, m, present in registry if present}
    by_md5 = {}
    for k, f, m, _ in registry:
        by_md5.setdefault(m, f)
    out = []
    for _, slug, url, md5 in links:
        drive = "/file/d/" in url
        key = url.split("/file/d/")[1].split("/")[0] if drive else url
        own = f"{key}.pdf" if drive else url.rsplit("/", 1)[1]
        if key in reg:
            out.append((slug, url, reg[key][0], "skipped"))
        elif md5 is None:
            out.append((slug, url, "" if drive else own, "failed"))
        else:
            name = by_md5.get(md5)
            status = "deduplicated" if drive and name else "downloaded"
            name = name or own
            by_md5.setdefault(md5, name)
            reg[key] = (name, md5)
            out.append((slug, url, name, status))
    return out


def test_downloads_match_the_sequential_rule(spark):
    rng = random.Random(4)
    for _ in range(3):
        registry = [(f"K{i}", f"r{i}.pdf", f"m{rng.randint(0, 9)}", rng.random() < 0.5) for i in range(4)]
        links = []
        for i in range(40):
            k = rng.randint(0, 9)
            url = f"https://drive.google.com/file/d/K{k}/view" if rng.random() < 0.6 else f"https://x.org/d{k}.pdf"
            md5 = None if rng.random() < 0.15 else f"m{k}" if rng.random() < 0.7 else f"m{rng.randint(0, 12)}"
            links.append((i, "p", url, md5))
        reg = spark.createDataFrame([(*r, i) for i, r in enumerate(registry)],
                                    "key string, filename string, md5 string, present boolean, ord bigint")
        df = spark.createDataFrame(links, "ord bigint, policy_slug string, url string, md5 string")
        got = [tuple(r)[1:] for r in sorted(R.classify_downloads(df, reg).collect(), key=lambda r: r["ord"])]
        assert got == brute_downloads(links, registry)


def test_image_pages(spark):
    names = ["img-003-001.jpg", "img-x-1.png", "cover.png", "img-12.png", "img-7-1-2.gif"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(R.image_page(F.col("f"))).collect()] == [3, 0, 0, 0, 7]


def test_freshness_edges(spark):
    rows = [("u", "blog", "2026-01-01T00:00:00"), ("u", "blog", "2026-01-01T00:00:00.000001"), ("u", "odd", "x"),
            ("u", "odd", "2025-12-31T20:00:00")]
    df = spark.createDataFrame(rows, "url string, category string, cached_at string")
    got = [r["hit"] for r in with_freshness(df, "2026-01-01T06:00:00").collect()]
    assert got == [False, True, False, True]
    assert not any(r["hit"] for r in with_freshness(df, "2026-01-01T06:00:00", force_refresh=True).collect())
    stats = {r["category"]: r.asDict() for r in snapshot_stats(with_freshness(df, "2026-01-01T06:00:00")).collect()}
    assert stats["TOTAL"]["hit_rate"] == 50 and stats["other"]["entries"] == 2


def test_published_item_counts(spark):
    """Counts per type and total of the published corpus."""
    sizes = {"blog-post": 27, "event": 22, "party-information": 5, "pdf-document": 8, "policy": 16, "team-member": 44}
    rows = [(t, "2026-07-16T02:06:13") for t, n in sizes.items() for _ in range(n)]
    items = spark.createDataFrame([*rows, ("podcast", "2026-07-01T00:00:00")], "content_type string, cleaned_at string")
    got = {r["content_type"]: r for r in G.dataset_status(items, "2026-07-20 00:00:00").collect()}
    assert {t: r["items"] for t, r in got.items()} == {**sizes, "podcast": 1, "TOTAL": 123}
    assert got["TOTAL"]["freshness"] == "fresh" and got["TOTAL"]["last_cleaned_at"] == "2026-07-16T02:06:13"
    old = G.dataset_status(items, "2026-08-20 00:00:00").collect()
    assert {r["freshness"] for r in old} == {"stale"}


def test_quality_report_layout(spark):
    rows = [("a.pdf", 10992, 11017, 1, 1, 0.9678, 5, 6, 7, True, [])]
    line = G.quality_report(spark.createDataFrame(rows, schemas.VALIDATION)).first()["line"]
    assert line == "| `a.pdf` | 10,992 | 11,017 | 96.8% | 5 | 6 | 7 | ✅ pass |"


def test_order_ignores_case_and_accents_first(spark):
    df = spark.createDataFrame([(n, n) for n in ("b", "B", "é", "a", "A")], "slug string, name string")
    assert [r[0] for r in df.orderBy(*[k.sort() for k in G.collection_order("team")]).collect()] == ["a", "A", "b", "B", "é"]


def test_leader_with_electorate_is_preferred(spark):
    rows = [(1, "Q", "Party Leader", ""), (2, "Qiu", "Party Leader", "Mt"), (3, "D", "Deputy Leader", ""),
            (4, "C", "Candidate", "Mt")]
    facts = G.roster_facts(spark.createDataFrame(rows, "o int, name string, role string, electorate string"), "o").first()
    assert (facts["total"], facts["electorates"], facts["leader"], facts["deputy"]) == (4, 1, "Qiu", "D")


# --- find -------------------------------------------------------------------


@pytest.mark.parametrize("bad", [
    {"nope": 1}, {"query": " "}, {"query": "x" * 201}, {"limit": 0}, {"limit": 101}, {"offset": -1},
    {"limit": "5"}, {"date_from": "2026-13-01"}, {"limit": True}, {"tags": [1]},
])
def test_bad_arguments(bad):
    allowed = {"query", "limit", "offset", "date_from", "tags"}
    with pytest.raises(ValueError):
        FD.check_arguments(allowed, bad, ("query",), ("date_from",))


def test_pages(spark):
    df = spark.range(45).withColumn("v", F.col("id") % 7)
    order = [down("v"), up("id")]
    ids = [r["id"] for r in df.orderBy(F.desc("v"), F.asc("id")).collect()]
    for offset, limit in ((0, 20), (40, 20), (44, 1), (60, 5)):
        page = FD.paginate(df, order, limit, offset)
        assert [r["id"] for r in page.items.collect()] == ids[offset:offset + limit]
        e = page.envelope.first()
        assert (e["total"], e["count"]) == (45, len(ids[offset:offset + limit]))
        assert e["has_more"] == (offset + limit < 45)
        assert e["next_offset"] == (offset + limit if e["has_more"] else None)


def test_pages_by_offset_and_after_the_last_row(spark):
    df = spark.range(100)
    page = FD.paginate(df, [down("id")], 5, 50)
    assert [r["id"] for r in page.items.collect()] == [49, 48, 47, 46, 45]
    page = FD.paginate(df, [down("id")], 5, after=F.col("id") < 50)
    assert [r["id"] for r in page.items.collect()] == [49, 48, 47, 46, 45]


def test_page_json(spark):
    import json

    page = FD.paginate(spark.range(3), [up("id")], 2, 0)
    assert json.loads(FD.page_json(page).first()["json"]) == {
        "total": 3, "count": 2, "offset": 0, "has_more": True, "next_offset": 2, "items": [{"id": 0}, {"id": 1}]}


def test_get_item_rejects_unknown_type(spark):
    with pytest.raises(ValueError):
        FD.get_item(spark.createDataFrame([], schemas.CLEAN_ITEM), "video", "x")
    with pytest.raises(ValueError):
        N.category_select(spark.range(1), "id", ["x"], ["y"])


def test_date_bounds_reach_the_scan(spark, tmp_path):
    rows = [(f"e{i}", "event", f"2026-01-{i + 1:02d}" if i else "soon") for i in range(9)]
    df = spark.createDataFrame(rows, "slug string, content_type string, date string")
    schemas.conform(df).write.partitionBy("content_type").parquet(str(tmp_path / "i"))
    items = spark.read.parquet(str(tmp_path / "i"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    got = FD.matching_events(items, "2026-01-04", date_to="2026-01-06")
    assert sorted(r["slug"] for r in got.collect()) == ["e3", "e4", "e5"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(date,2026-01-04)" in plan and "PartitionFilters: [isnotnull(content_type" in plan
    past = FD.matching_events(items, "2026-01-04", include_past=True, date_to="20260103")
    assert sorted(r["slug"] for r in past.collect()) == ["e0", "e1", "e2"]
    assert FD.matching_events(items, "2026-01-04", include_past=True).count() == 8


def test_piece_of_a_row_equals_counting_all_cuts(spark):
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("a")).cache()
    order = [scale.down("a"), scale.up("id")]

    def place(a, n):
        return (a is None, -(a or 0), n)

    for pieces in (2, 3, 17, 256):
        cuts = scale._cuts(rows, order, 3_000, pieces)
        got = rows.withColumn("p", scale._piece(rows, order, cuts)).collect()
        assert all(r["p"] == sum(place(*c) <= place(r["a"], r["id"]) for c in cuts) for r in got)


def test_split_by_bits_loses_no_wanted_row(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "x"), ("a", "x")], "k string, f string")
    near, rest = scale.split_by_bits(rows, ["k", "f"], spark.createDataFrame([("a", "x"), ("b", None)], "k string, f string"))
    assert sorted(map(tuple, near.collect()), key=str) == [("a", "x"), ("a", "x"), ("b", None)]
    assert sorted(map(tuple, rest.collect()), key=str) == [("a", "y"), (None, "x")]
    none, every = scale.split_by_bits(rows, ["k", "f"], rows.filter("false"))
    assert none.count() == 0 and every.count() == 5


def test_short_rows_are_dealt_out_by_number(spark, tmp_path):
    from corpusloom.plans import book

    spark.range(book.ROWS_A_TASK * 3).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    dealt = book.spread(rows)
    assert dealt.rdd.getNumPartitions() >= 3 and dealt.agg(F.sum("id")).first() == rows.agg(F.sum("id")).first()


def test_events_of_one_small_file_become_many_tasks(spark, tmp_path):
    from corpusloom.plans import book, seeds

    spark.range(book.ROWS_A_TASK * 3).select(
        F.col("id").alias("event_id"), F.lit("2026-01-01 10:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"), F.lit("view").alias("event_type"), F.lit("{}").alias("props"),
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    rows = seeds.event_md(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() >= 3 and rows.count() == book.ROWS_A_TASK * 3
