"""Queries against their SQL, and operators against brute force, on whole small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash

from conftest import SF
from corpusloom.llm import book, fingerprint, mixing, pieces
from corpusloom.llm.common import WORD
from oracle import compare

DOCS = f"{SF}/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(DOCS).collect()}


@pytest.mark.parametrize("name", sorted(book.ORACLES))
def test_sql(spark, con, name):
    assert compare(con, book.QUERIES[name](spark, SF), book.ORACLES[name]) is None


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in book.QUERIES) == list(range(1, 14))


def winnow(text, k=fingerprint.K, w=fingerprint.W):
    words = re.findall(WORD, text)
    if not words:
        return []
    hashes = []
    for i in range(max(1, len(words) - k + 1)):
        h = 42
        for word in words[i : i + k]:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
        hashes.append(h - (1 << 64) if h >> 63 else h)
    out = []
    for i in range(max(1, len(hashes) - w + 1)):
        part = [(h >> fingerprint.PLACE_BITS, -(i + j), i + j) for j, h in enumerate(hashes[i : i + w])]
        place = min(part)[2]
        if place not in out:
            out.append(place)
    return [(p, hashes[p]) for p in out]


def shown(prints):
    return " ".join(f"{p:x}:{h & (1 << 64) - 1:x}" for p, h in prints)


def near(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, documents):
    got = {r["doc_id"]: r for r in book.QUERIES["op3_winnowing"](spark, SF).collect()}
    ids = sorted(documents)
    assert sorted(got) == ids
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        text, other = documents[i]["text"], documents[j]["text"]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        a, b = winnow(text), winnow(edited)
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(a), shown(b))
        assert r["near_edited"] == pytest.approx(near(a, b)) and r["near_next"] == pytest.approx(near(a, winnow(other)))


def test_mixing(spark, documents):
    rows = book.QUERIES["op5_source_mixing"](spark, SF).collect()
    assert {(r["doc_id"], r["size"], r["source"]) for r in rows} == {
        (i, len(re.findall(WORD, r["text"])), r["source"]) for i, r in documents.items()}
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    left, open_now, aim = 1.5 * sum(sizes.values()), dict(zip(sorted(sizes), [3, 1, 2] * 99)), {}
    while True:
        each = {s: left * w / sum(open_now.values()) for s, w in open_now.items()}
        full = [s for s in each if each[s] > 2 * sizes[s]]
        if not full:
            aim |= each
            break
        for s in full:
            aim[s] = 2 * sizes[s]
            left -= aim[s]
            del open_now[s]
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(aim[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - aim[s]) <= 1 for s in sizes)
    again = book.QUERIES["op5_source_mixing"](spark, SF).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_flow_routes_around_and_repeats_last():
    # b can only use what a shares with it; a moves aside to its own tokens
    given = mixing.flow([(("a",), 10), (("a", "b"), 10)], {"a": 10, "b": 10}, 2)
    assert given == [{"a": 10}, {"a": 0, "b": 10}]
    given = mixing.flow([(("a",), 10), (("b",), 10)], {"a": 15, "b": 5}, 2)
    assert given == [{"a": 15}, {"b": 5}]
    # brute force over all integer flows of a small case: least repeated tokens
    patterns, need = [(("a", "b"), 2), (("b", "c"), 1), (("a",), 1)], {"a": 2, "b": 2, "c": 1}
    given = mixing.flow(patterns, need, 2)
    assert {s: sum(g.get(s, 0) for g in given) for s in need} == need
    assert sum(max(0, sum(g.values()) - t) for g, (_, t) in zip(given, patterns, strict=True)) == 1


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = {}
    for r in book.QUERIES["op7_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        assert sorted(got[q]) == list(range(1, 11))
        for v, s in got[q].values():
            assert s == pytest.approx(float(d[ids == v][0]), rel=1e-12)
        hits += len({v for v, _ in got[q].values()} & set(ids[order].tolist()))
        total += 10
    assert hits >= 0.9 * total


def test_pieces(spark, documents):
    rows = book.QUERIES["op8_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(documents) and all(r["lossless"] for r in rows)
    model, library = pieces.PieceModel.load(), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [r["text"] for r in list(documents.values())[:40]] + ["", "  two  spaces ", "ab" * 700, "日本語" * 200, "\n"]
    plain = model.encode(texts, np.zeros(len(texts), np.uint64))
    assert [x.tolist() for x in plain] == [library.encode(t) for t in texts]
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256(documents[r["doc_id"]]["text"].encode()).hexdigest()
        assert model.decode(r["ids"]) == documents[r["doc_id"]]["text"] and r["n_pieces"] == len(r["ids"])
    one = model.encode([texts[0]] * 2, np.array([1, 2], np.uint64), 0.3)
    assert one[0].tolist() != one[1].tolist() and model.decode(one[0]) == model.decode(one[1]) == texts[0]
    short = model.encode(texts, np.full(len(texts), 5, np.uint64), 0.2)
    long, pieces.LONG = pieces.LONG, 3
    try:
        heaped = model.encode(texts, np.full(len(texts), 5, np.uint64), 0.2)
    finally:
        pieces.LONG = long
    assert all((a == b).all() for a, b in zip(short, heaped, strict=True))


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = book.QUERIES["op2_language_id"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in book.QUERIES["op9_quality_classifier"](spark, sf).collect()]
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert np.mean([r["predicted"] == marks[r["doc_id"]] for r in held]) > 0.85


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = book.QUERIES["op11_toxicity"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert np.mean([r["predicted"] == marks[r["doc_id"]] for r in held]) > 0.9
