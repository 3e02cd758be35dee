"""The snapshot log and the text index against plain recomputation."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import find as FD
from corpusloom.operators import snapshots as S
from corpusloom.sources import store, trigrams, writers
from corpusloom.sources.snapshot_log import SnapshotLog

SNAP = "url string, category string, cached_at string, content string, n bigint"


def _snaps(rng, start, count):
    stamps = ["2026-01-01 10:00:00", "2026-01-02 09:00:00", "2026-01-02 11:00:00", "garbled", None, ""]
    return [(rng.choice(["u1", "u2", "a/b=c", None]), rng.choice(["blog", "x y/z=%", None, ""]), rng.choice(stamps), f"c{i}", i)
            for i in range(start, start + count)]


def _latest(rows):
    best = {}
    for r in rows:
        k, order = (r[1], r[0]), (r[2] is not None, r[2] or "", r[4])
        if k not in best or order > best[k][0]:
            best[k] = (order, r)
    return {k: r for k, (_, r) in best.items()}


def _read(df):
    return {(r["category"], r["url"]): (r["url"], r["category"], r["cached_at"], r["content"], r["n"]) for r in df.collect()}


def test_log_equals_upserts_before_and_after_compaction(spark, tmp_path):
    rng = random.Random(5)
    schema = spark.createDataFrame([], SNAP).schema
    log, every = SnapshotLog(spark, str(tmp_path / "log"), schema, "n"), []
    assert log.read().count() == 0 and log.compact() == [] and log.invalidate() == 0
    for start in (0, 20, 40):
        rows = _snaps(rng, start, 12)
        every += rows
        log.append(spark.createDataFrame(rows, SNAP))
        assert _read(log.read()) == _latest(every)
    gone = log.compact()
    assert gone and _read(log.read()) == _latest(every)
    assert log.compact() == []
    stored = store.read_table(spark, log.path, store.current(spark, log.path), "snapshots", schema)
    assert stored.count() == len(_latest(every))
    assert store.vacuum(spark, log.path, 1) > 0 and _read(log.read()) == _latest(every)
    plain = S.fresh_snapshots(S.upsert_snapshots(spark.createDataFrame(every, SNAP), None, "n"), "2026-01-02 12:00:00")
    assert _read(log.fresh("2026-01-02 12:00:00")) == _read(plain)
    removed = log.invalidate(("blog",))
    left = {k: r for k, r in _latest(every).items() if k[0] != "blog"}
    assert removed == len(_latest(every)) - len(left) and _read(log.read()) == left


def test_log_reads_and_rewrites_only_what_it_needs(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "log"), spark.createDataFrame([], SNAP).schema, "n")
    old = [(f"u{i}", "blog", "2025-12-01 00:00:00", "old", i) for i in range(5)]
    log.append(spark.createDataFrame([*old, ("v", "team", "2025-12-05 00:00:00", "t", 9)], SNAP))
    first = set(store.current(spark, log.path).tables["snapshots"])
    log.append(spark.createDataFrame([("u1", "blog", "2026-01-02 00:00:00", "new", 10)], SNAP))
    assert first < set(store.current(spark, log.path).tables["snapshots"])
    fresh = log.fresh("2026-01-02 01:00:00")
    assert [r["content"] for r in fresh.collect()] == ["new"]
    assert len(fresh.inputFiles()) == 1 and "day=2026-01-02" in fresh.inputFiles()[0]
    assert log.fresh("2026-01-02 01:00:00", force_refresh=True).count() == 0
    # only the folder of the superseded row is replaced
    assert ["kind=c-blog/day=2025-12-01" in k for k in log.compact()] == [True]
    assert {r["url"]: r["content"] for r in log.read(("blog",)).collect()} == {
        "u0": "old", "u1": "new", "u2": "old", "u3": "old", "u4": "old"}


def test_a_day_in_many_folders_is_joined(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "log"), spark.createDataFrame([], SNAP).schema, "n")
    for i in range(4):
        log.append(spark.createDataFrame([(f"u{i}", "blog", "2026-01-02 00:00:00", "x", i)], SNAP))
    assert log.compact(most_batches=4) == [] and len(log.compact(most_batches=3)) == 4
    assert len(store.current(spark, log.path).tables["snapshots"]) == 1 and log.read().count() == 4


ITEM = "slug string, content_type string, title string, name string, body string, date string"
WORDS = ["Ōtaki", "river", "TAX", "tax cuts", "ß", "😀 plan", "a.b*c", "Straße", "\n\n", "ΟΔΟΣ", "aaa", "aaaa", ""]


def _items(rng, spark, slugs):
    def text():
        return rng.choice([None, "", " ".join(rng.choices(WORDS, k=4))])

    rows = [(s, "blog-post", text(), None, text(), "2026-01-01") for s in slugs]
    return schemas.conform(spark.createDataFrame(rows, ITEM))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng, path = random.Random(3), str(tmp_path_factory.mktemp("indexed"))
    writers.write_clean_items(_items(rng, spark, [f"s{i}" for i in range(30)]), path, 4)
    writers.index_store(spark, path)
    writers.write_clean_items(_items(rng, spark, [f"s{i}" for i in range(20, 40)]), path, 4)
    return path


@pytest.mark.parametrize("needle", ["tax", "AX C", "ōTAKI", "😀 p", "a.b*", "aaaa", "straße", "οδος", "ta", "x", "none of them", "\n\n"])
def test_index_finds_what_a_scan_finds(spark, indexed, needle):
    held = writers.read_store(spark, indexed)
    if not needle.strip():
        assert {r["slug"] for r in held.index.items_with(needle, "blog-post").collect()} == {f"s{i}" for i in range(40)}
        return
    by_scan = FD.find_blog_posts(held.items, query=needle, limit=100).items
    by_index = FD.find_blog_posts(held, query=needle, limit=100).items
    assert by_index.collect() == by_scan.collect()


def test_search_reads_candidate_partitions_only(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(f"s{i}", "blog-post", f"title {i}", None, "needle" if i == 7 else "hay", "2026-01-01") for i in range(40)]
    writers.write_clean_items(schemas.conform(spark.createDataFrame(rows, ITEM)), path, 8)
    writers.index_store(spark, path)
    held = writers.read_store(spark, path)
    found = held.index.items_with("NEEDLE", "blog-post")
    assert [r["slug"] for r in found.collect()] == ["s7"]
    files = [f for f in found.inputFiles() if "/items/" in f]
    assert len({f.rsplit("/", 2)[0] for f in files}) == 1
    assert "In(gram" in held.index.hits(trigrams.ITEMS, "needle")._jdf.queryExecution().toString()
    assert held.index.items_with("absent", "blog-post").count() == 0


def test_postings_grow_with_grams_not_with_rows(spark):
    rows = spark.range(5_000).select(
        F.concat(F.lit("s"), "id").alias("slug"), F.lit("event").alias("content_type"), F.lit("0-of-1").alias("bucket"),
        F.lit("").alias("title"), F.lit(None).cast("string").alias("name"), F.lit("props abc").alias("body"))
    found = trigrams.postings(rows, trigrams.ITEMS)
    assert found.count() <= 7 * trigrams.BLOCKS < 5_000 * 7
    assert found.groupBy("gram", "doc").count().filter("count > 1").isEmpty()


def test_search_by_index_with_null_keys_and_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "n")
    rows = [(s, "policy", t, None, "body", None) for s, t in [(None, "Tax"), (None, "tax"), ("a", "TAX"), ("a", "tax"), ("b", "x")]]
    writers.write_clean_items(schemas.conform(spark.createDataFrame(rows, ITEM)), path, 4)
    writers.index_store(spark, path)
    held = writers.read_store(spark, path)
    assert held.index.items_with("tax", "policy").count() == 4
    also = spark.createDataFrame([("b",)], "slug string")
    assert {r["slug"] for r in held.index.items_with("tax", "policy", also).collect()} >= {None, "a", "b"}


def test_sections_that_stay_and_sections_without_a_policy(spark, tmp_path):
    path = str(tmp_path / "k")

    def told(*rows):
        return spark.createDataFrame([(*r, "", "d") for r in rows], "slug string, file string, heading string, detail string")

    policies = schemas.conform(spark.createDataFrame([("p", "policy", "t", None, "b", None)], ITEM))
    writers.write_clean_items(policies, path, 1, told(("p", "a"), ("q", "a"), (None, "a")))
    writers.write_sections(told(("p", "b")), policies.select("slug"), path, 1)
    held = writers.read_store(spark, path)
    assert {(r["slug"], r["file"]) for r in held.sections.collect()} == {("p", "b"), ("q", "a"), (None, "a")}
    writers.rebuild_site_tables(held, str(tmp_path / "site"))
    assert [r["slug"] for r in spark.read.parquet(f"{tmp_path}/site/policy-sections").collect()] == ["p"]


def test_a_first_write_joins_nothing(spark):
    empty = store.read_table(spark, "none", store.Version(), "items", writers.STORED_ITEM)
    assert "Scan" not in empty._jdf.queryExecution().optimizedPlan().toString() and empty.count() == 0
    assert empty._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")


def test_sections_are_found_by_index_and_follow_their_policy(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = [(f"p{i}", "policy", f"t{i}", None, "body", None) for i in range(12)]
    policies = schemas.conform(spark.createDataFrame(rows, ITEM))
    def detail(text):
        return spark.createDataFrame([("p3", "a.pdf", "", text), ("p3", "b.pdf", "", "other")], schemas.SECTION)

    writers.write_clean_items(policies, path, 4, detail("the old words"))
    writers.index_store(spark, path)

    def found(needle):
        return [r["slug"] for r in FD.find_policies(writers.read_store(spark, path), query=needle).items.collect()]

    assert found("OLD W") == ["p3"] and found("t3") == ["p3"]
    writers.write_sections(detail("new words"), policies.select("slug").filter("slug = 'p3'"), path, 4)
    assert found("old w") == [] and found("new w") == ["p3"]


def test_grams_of_odd_texts(one):
    assert one(trigrams.grams, None) == [] and one(trigrams.grams, "ab") == []
    assert one(trigrams.grams, "ABCa") == ["abc", "bca"]
    assert one(lambda t: F.size(trigrams.grams(F.repeat(t, 200_000))), "xyz") == 3


def test_a_key_seen_long_ago_is_dropped(spark, tmp_path):
    from corpusloom.streaming.incremental import first_seen_ever, read_first_seen

    landed, table = tmp_path / "in", str(tmp_path / "t")
    schema = spark.createDataFrame([], "k string, n int").schema
    batches = [[("a", 2), ("a", 1), ("b", 3)], [("c", 4)], [(None, 5), (None, 6)], [("a", 7), (None, 8), ("d", 9)], [("b", 10)]]

    def run():
        stream = spark.readStream.schema(schema).json(str(landed))
        first_seen_ever(stream, "k", ["n"], table, str(tmp_path / "p"), buckets=2, most_batches=2).awaitTermination()
        return {r["k"]: r["n"] for r in read_first_seen(spark, table, schema).collect()}

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(landed))
        got = run()  # a restart each time
    assert got == {"a": 1, "b": 3, "c": 4, None: 5, "d": 9}
    assert read_first_seen(spark, table, schema).count() == 5
    live = store.current(spark, table).tables["seen"]
    assert all(sum(k.endswith(f"bucket={b}") for k in live) <= 3 for b in range(2))
