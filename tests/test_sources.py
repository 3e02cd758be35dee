import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import find as FD
from corpusloom.operators import normalise as N
from corpusloom.operators.validate import validate
from corpusloom.sources import readers, writers
from corpusloom.sources import registry as SR
from corpusloom.streaming.incremental import first_seen_stream, incremental_clean


def test_json_index(spark, tmp_path):
    rows = [{"slug": "a", "title": "A"}, {"slug": "b", "title": "B"}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "bad.json").write_text("{oops")
    read = readers.scan_json_index
    got = read(spark, str(tmp_path / "a.json"), schemas.INDEX_ENTRY, array=True).collect()
    assert [(r["slug"], r["title"], r["date"]) for r in got] == [("a", "A", None), ("b", "B", None)]
    assert read(spark, str(tmp_path / "bad.json"), schemas.INDEX_ENTRY, array=True).count() == 0
    assert read(spark, str(tmp_path / "none.json"), schemas.INDEX_ENTRY).count() == 0


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text(
        '{"id":"1","title":"T","url":"https://v/1","duration":61}\n\n{bad\n{"url":"u2"}\n{"title":"no id"}\n'
        '{"id":"3","ie_key":"K","url":"rel"}\n')
    got = readers.scan_jsonl_lenient(spark, str(tmp_path / "x.jsonl"), "shorts", "https://w/?v=").collect()
    assert [(r["id"], r["title"], r["url"], r["tab"]) for r in got] == [
        ("1", "T", "https://v/1", "shorts"), ("u2", "u2", "https://w/?v=u2", "shorts"),
        ("3", "K", "https://w/?v=3", "shorts")]


def test_item_files(spark, tmp_path):
    for slug in ("one", "two words", "_skip"):
        d = tmp_path / "policy" / slug
        d.mkdir(parents=True)
        (d / f"{slug}.md").write_text(f'---\ntitle: "{slug}"\n---\nbody of {slug}')
        (d / "notes.md").write_text("x")
    (tmp_path / "policy" / "one" / "meta.json").write_text('{"slug": "one"}')
    got = {r["slug"]: r for r in readers.scan_item_files(spark, str(tmp_path)).collect()}
    assert set(got) == {"one", "two words"}
    assert got["one"]["body"] == "body of one" and got["one"]["meta"] == '{"slug": "one"}'
    assert got["two words"]["content_type"] == "policy" and got["two words"]["meta"] is None


def test_pdf_files(spark, tmp_path):
    for name, data in (("a.pdf", b"%PDF-1.7"), ("b.pdf", b"<html>"), ("c.pdf", b"")):
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: r["is_pdf"] for r in readers.scan_pdf_files(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": True, "b.pdf": False, "c.pdf": False}
    assert readers.scan_pdf_files(spark, str(tmp_path / "none")).count() == 0


def test_feed(spark):
    item = "<item><title> T{0} </title><link>http://h.org/p{0}</link><pubDate>Mon, 08 Jun 2026 23:30:00 -0900</pubDate></item>"
    xml = "<rss><channel>" + "<item><title>x</title></item>" + "".join(item.format(i) for i in range(60)) + "</channel></rss>"
    df = spark.createDataFrame([(1, xml), (2, "<rss><channel/></rss>")], "feed_id int, xml string")
    got = readers.feed_items(df).orderBy("ord").collect()
    assert len(got) == 60
    assert tuple(got[0])[1:] == (0, "T0", "/p0", "2026-06-08", "")


def _items(spark, rows):
    df = spark.createDataFrame(rows, "slug string, content_type string, title string, body string")
    extra = {c: F.lit("s") for c in schemas.PROVENANCE if c not in ("slug", "content_type")}
    return schemas.conform(df.withColumns(extra))


def test_write_clean_items_merges(spark, tmp_path):
    path = str(tmp_path / "items")
    writers.write_clean_items(_items(spark, [("a", "policy", "A", "x"), ("b", "policy", "B", "x"), ("e", "event", "E", "x")]), path, 4)
    kept = [p.name for p in (tmp_path / "items" / "items" / "content_type=event").rglob("*.parquet")]
    writers.write_clean_items(_items(spark, [("a", "policy", "A2", "y"), ("c", "policy", "C", "\n\nz")]), path, 4)
    got = {r["slug"]: (r["title"], r["body"]) for r in writers.read_clean_items(spark, path).collect()}
    assert got == {"a": ("A2", "y"), "b": ("B", "x"), "c": ("C", "\n\nz"), "e": ("E", "x")}
    md = writers.read_clean_items(spark, path).filter("slug = 'c'").first()["rendered_md"]
    assert md.startswith('---\nslug: "c"\ncontent_type: "policy"') and md.endswith('title: "C"\n---\nz')
    with pytest.raises(ValueError):
        writers.write_clean_items(_items(spark, [("a", "policy", "A2", "y")]), path, 8)
    with pytest.raises(ValueError):
        writers.write_clean_items(_items(spark, [("a", "video", "A2", "y")]), path, 4)
    # types that were not touched keep their files
    assert kept and kept == [p.name for p in (tmp_path / "items" / "items" / "content_type=event").rglob("*.parquet")]
    plan = writers.read_clean_items(spark, path).filter("content_type = 'event' and slug = 'e'")
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(content_type" in text and "PushedFilters: [IsNotNull(slug)" in text


def _sections(spark, rows, paged):
    pdfs = spark.createDataFrame(rows, "policy_slug string, file string, raw string")
    return N.policy_sections(pdfs, spark.createDataFrame([(s,) for s in paged], "slug string"))


def _pdf(text):
    return f"# T\n| a | b |\n\n{text}"


def test_sections_are_stored_published_and_found(spark, tmp_path):
    path, site = str(tmp_path / "items"), str(tmp_path / "site")
    items = _items(spark, [(s, "policy", s, "page") for s in "ab"] + [("c", "policy", "c", "")])
    files = [("a", "pdf-2.md", _pdf("needle two")), ("a", "pdf-1.md", _pdf("needle one")), ("b", "pdf-1.md", _pdf("bee")),
             ("c", "pdf-1.md", _pdf("needle alone"))]
    writers.write_clean_items(items, path, 4, _sections(spark, files, "ab"))

    def found(text):
        page = FD.find_policies(writers.read_store(spark, path), query=text)
        return [r["slug"] for r in page.items.collect()]

    def published():
        writers.rebuild_site_tables(writers.read_store(spark, path), site)
        rows = spark.read.parquet(f"{site}/policy-sections").coalesce(1).collect()
        return sorted((r["slug"], r["file"], r["md"]) for r in rows)

    head = "## Full Policy Detail\n\n"
    got = published()
    assert [r[:2] for r in got] == [("a", "pdf-1.md"), ("a", "pdf-2.md"), ("b", "pdf-1.md"), ("c", "pdf-1.md")]
    assert [r[2].startswith(head) for r in got] == [True, False, True, False]
    assert [r[2].removeprefix(head).split("\n")[-1] for r in got] == ["needle one", "needle two", "bee", "needle alone"]
    assert found("needle") == ["a", "c"] and found("bee") == ["b"]
    # an upsert without sections leaves them; one with sections replaces those of its policies as a set
    writers.write_clean_items(_items(spark, [("a", "policy", "a", "new page")]), path, 4)
    assert published() == got
    writers.write_clean_items(
        _items(spark, [("a", "policy", "a", "x"), ("c", "policy", "c", "")]), path, 4,
        _sections(spark, [("a", "pdf-2.md", _pdf("short"))], "a"))
    assert [(r[0], r[1], r[2].startswith(head)) for r in published()] == [("a", "pdf-2.md", True), ("b", "pdf-1.md", True)]
    assert found("needle") == [] and found("short") == ["a"]
    with pytest.raises(ValueError):
        writers.write_sections(_sections(spark, files, "ab"), items.select("slug"), path, 8)


def test_validation_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a.pdf", "one two", "one two"), ("b.pdf", "one", "x")],
                                 "filename string, raw_text string, raw_md string")
    results = validate(docs)
    writers.write_validation(results, str(tmp_path / "v"))
    back = writers.load_validation(spark, str(tmp_path / "v"))
    assert sorted(map(str, back["results"].collect())) == sorted(map(str, results.select(*schemas.VALIDATION.names).collect()))
    head = back["summary"].first()
    assert (head["threshold"], head["pdf_count"], head["passed_count"]) == (0.95, 2, 1)
    assert writers.load_validation(spark, str(tmp_path / "none")) == {}


def test_site_is_rebuilt(spark, tmp_path):
    path = str(tmp_path / "site")
    writers.rebuild_site_tables(_items(spark, [("a", "policy", "A", "x"), ("b", "policy", "", "x")]), path)
    writers.rebuild_site_tables(_items(spark, [("b-c", "policy", "", "x")]), path)
    got = spark.read.parquet(f"{path}/policies").collect()
    assert [(r["slug"], r["md"]) for r in got] == [
        ("b-c", '---\ntitle: "B C"\nslug: b-c\nurl: "s"\nscrapedAt: "s"\n---\nx')]


def test_cached_listing(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "c")
    assert readers.cached_listing(spark, path, build).count() == 1
    assert readers.cached_listing(spark, path, build).count() == 1 and len(calls) == 1
    assert readers.cached_listing(spark, path, build, refresh=True).count() == 2


def test_source_contract(spark):
    SR.register_source("good", lambda s: _items(s, [("a", "policy", "A", "x")]))
    SR.register_source("bad", lambda s: s.range(1))
    assert SR.run_sources(spark, ["good"]).first()["slug"] == "a"
    with pytest.raises(ValueError):
        SR.source_items(spark, "bad")
    with pytest.raises(ValueError):
        SR.register_source("good", lambda s: s.range(1))


def test_incremental_batches(spark, tmp_path):
    raw, items, progress = (str(tmp_path / n) for n in ("raw", "items", "progress"))
    schema = "slug string, raw string, v int"

    def run():
        stream = spark.readStream.schema(schema).parquet(raw)
        incremental_clean(
            stream, lambda b: schemas.conform(N.clean_team(b, "t")), items, progress, 4, order="v"
        ).awaitTermination()
        return {r["slug"]: r["role"] for r in writers.read_clean_items(spark, items).collect()}

    spark.createDataFrame([("a", "**Role**: X", 2), ("a", "**Role**: old", 1), ("b", "**Role**: Y", 1)], schema).write.parquet(raw)
    assert run() == {"a": "X", "b": "Y"}
    spark.createDataFrame([("b", "**Role**: Z", 2), ("c", "**Role**: W", 1)], schema).write.mode("append").parquet(raw)
    assert run() == {"a": "X", "b": "Z", "c": "W"}


def test_first_seen_across_batches(spark, tmp_path):
    raw, out, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))
    schema = "id int, ts timestamp"
    rows = spark.createDataFrame([(i % 5,) for i in range(50)], "id int").withColumn(
        "ts", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    for _ in range(2):
        rows.write.mode("append").parquet(raw)
        stream = spark.readStream.schema(schema).parquet(raw)
        (first_seen_stream(stream, "id", "ts", "1 day").writeStream.format("parquet")
         .option("checkpointLocation", progress).option("path", out)
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_late_row_does_not_hide_one_in_time(spark, tmp_path):
    raw, out, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))

    def run(rows):
        spark.createDataFrame(rows, "id int, day int").selectExpr(
            "id", "timestamp '2026-01-01' + make_dt_interval(day) AS ts").coalesce(1).write.mode("append").parquet(raw)
        stream = spark.readStream.schema("id int, ts timestamp").parquet(raw)
        (first_seen_stream(stream, "id", "ts", "2 days").writeStream.format("parquet")
         .option("checkpointLocation", progress).option("path", out)
         .trigger(availableNow=True).start().awaitTermination())

    run([(99, 100)])
    run([(1, 1), (1, 101)])
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 99]


def test_a_failed_write_shows_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "items")
    items = _items(spark, [(s, "policy", "old", "page") for s in "ab"])
    writers.write_clean_items(items, path, 4, _sections(spark, [("a", "pdf-1.md", _pdf("old text"))], "ab"))

    def seen():
        held = writers.read_store(spark, path)
        return (held.version, sorted((r["slug"], r["title"]) for r in held.items.collect()),
                [(r["slug"], "new" in r["detail"]) for r in held.sections.collect()])

    before = (1, [("a", "old"), ("b", "old")], [("a", False)])
    assert seen() == before
    pinned = writers.read_store(spark, path)
    newer = _items(spark, [("a", "policy", "new", "page")])
    told = _sections(spark, [("a", "pdf-1.md", _pdf("new text"))], "a")
    with monkeypatch.context() as m:
        # items and sections are written, and the writer dies before the commit, or between the two tables
        for name in ("commit", "changed"):
            def fail(*_):
                raise KeyboardInterrupt
            m.setattr(writers.store, name, fail)
            with pytest.raises(KeyboardInterrupt):
                writers.write_clean_items(newer, path, 4, told)
            m.undo()
            assert seen() == before
    writers.write_clean_items(newer, path, 4, told)
    after = (2, [("a", "new"), ("b", "old")], [("a", True)])
    assert seen() == after
    # a reader of the old version still reads it, until its files are swept up
    assert sorted(r["title"] for r in pinned.items.collect()) == ["old", "old"]
    assert writers.read_store(spark, path, 1).sections.count() == 1
    assert writers.store.vacuum(spark, path, keep=1) > 0 and seen() == after
    with pytest.raises(RuntimeError):
        writers.store.commit(spark, path, writers.store.Version(2, 4))


def test_a_replayed_batch_is_merged_once(spark, tmp_path):
    path = str(tmp_path / "items")
    writers.write_clean_items(_items(spark, [("a", "policy", "A", "x")]), path, 4, batch=("s", 0))
    writers.write_clean_items(_items(spark, [("a", "policy", "B", "x")]), path, 4)
    writers.write_clean_items(_items(spark, [("a", "policy", "A", "x")]), path, 4, batch=("s", 0))
    assert writers.read_store(spark, path).version == 2
    assert [r["title"] for r in writers.read_clean_items(spark, path).collect()] == ["B"]


def test_a_text_needs_sections(spark):
    with pytest.raises(ValueError):
        FD.find_policies(_items(spark, [("a", "policy", "A", "x")]), query="x")


def test_feed_files(spark, tmp_path):
    def feed(name, *items):
        return f"<rss><channel><link> {name} </link>" + "".join(items) + "</channel></rss>"

    def item(link, title="T"):
        return f"<item><title>{title}</title><link>{link}</link><pubDate>Mon, 08 Jun 2026 23:30:00 +0000</pubDate></item>"

    many = feed("one", item("http://h.org/a"), item(""), item("http://h.org/b", "ā &amp; b"))
    (tmp_path / "many.xml").write_text(many + "\n<rss><channel><item><title>x</channel></rss>\n" + feed("two", item("/c")))
    (tmp_path / "own.xml").write_text('<?xml version="1.0"?>\n' + feed("three", item("/d")))
    (tmp_path / "none.xml").write_text("")
    (tmp_path / "text.xml").write_text("no feed")
    got = [tuple(r)[:5] for r in readers.scan_feeds(spark, str(tmp_path)).orderBy("feed", "ord").collect()]
    assert got == [("many.xml", "one", 0, "T", "/a"), ("many.xml", "one", 1, "ā & b", "/b"),
                   ("own.xml", "three", 0, "T", "/d"), ("many.xml", "two", 0, "T", "/c")]


def test_item_folders_round_trip(spark, tmp_path):
    from corpusloom.sources.files import write_item_folders

    rows = [("a b", "policy", "T ā", "body\n\nof a"), ("c", "policy", None, ""), ("a b", "blog-post", "x", "y")]
    items = writers.with_rendered(_items(spark, rows))
    for _ in range(2):  # written again, the files are the same
        assert write_item_folders(items, f"file:{tmp_path}/out") == 3
    got = {(r["content_type"], r["slug"]): r for r in readers.scan_item_files(spark, f"{tmp_path}/out").collect()}
    assert set(got) == {(r[1], r[0]) for r in rows}
    one = got["policy", "a b"]
    assert one["body"].strip() == "body\n\nof a" and json.loads(one["meta"])["title"] == "T ā"
    assert readers.scan_item_files(spark, f"{tmp_path}/nowhere").count() == 0
    with pytest.raises(Exception, match="no folder can be named"):
        write_item_folders(writers.with_rendered(_items(spark, [("a/b", "policy", "t", "x")])), f"{tmp_path}/bad")
