"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import (
    FREED_SHUFFLES, SMALL_BATCHES, WORD, bits_set, dropped, mix, query, settings, sieve, signed, stored, table,
    window_hashes, with_may_be_in, word_hashes, words_of,
)
from corpusloom.llm.components import components

PORTION = 1_000_000  # words counted at once
# A word is common if it is one in so many; this bounds the list of common words.
COMMON = 1_000_000
BLOCK = 512  # sets that meet each other in one piece
TILE_BITS = 26  # the bitmap of shared tiles has 2**TILE_BITS bits
TILE_SHIFT = 56  # a tile's number is an element with the band in its upper bits
BITS = 1  # the bitmap of a set has from 2**BITS bits for an element on
KNOWN_PAIRS = 200_000  # of pairs that a task has told already, as many are kept in mind


def runs_of(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of `words` words, in order; of the whole text, if it is shorter."""
    return window_hashes(h, min(words, len(h))) if len(h) else h


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of a text."""
    return np.unique(runs_of(word_hashes(words_of(text, lower=True)), words))


def least_overlap(n: int, percent: int) -> int:
    """What a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def band_of(n: int) -> int:
    """Sets of a band have at most 2**band elements; bitmaps of a band have one width."""
    return max(5, int(n - 1).bit_length())


def bitmap(h: np.ndarray, band: int) -> bytes:
    """One bit set for each element, at a place that its hash gives."""
    bits = np.zeros(1 << (band + BITS), np.uint8)
    bits[(mix(h) & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def as_number(bits: bytes) -> tuple[int, int]:
    """A bitmap as an integer, and its width."""
    return int.from_bytes(bits, "little"), 8 * len(bits)


def may_link(na: int, nb: int, a: tuple[int, int], b: tuple[int, int], percent: int) -> bool:
    """Whether sizes and bitmaps leave the likeness possible; the wider bitmap is folded to the other's width.

    Every bit that differs takes an element that only one of the sets has.
    """
    (x, wide_x), (y, wide_y) = a, b
    while wide_x > wide_y:
        wide_x //= 2
        x = (x >> wide_x) | (x & ((1 << wide_x) - 1))
    while wide_y > wide_x:
        wide_y //= 2
        y = (y >> wide_y) | (y & ((1 << wide_y) - 1))
    most = (na + nb - (x ^ y).bit_count()) // 2
    return 100 * most >= percent * (na + nb - most)


def common_words(docs: DataFrame) -> pd.Series:
    """Counts of the common words over all documents, by hash.

    They only order the prefixes, so that runs of common words and passages
    shared by many documents make no large tiles; any order gives the same
    links. Tasks report what they have seen twice in a portion, and all words of
    a small one, so that a table dealt over many tasks has the same common words.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def told(parts: list[np.ndarray]) -> pd.DataFrame:
            h, c = np.unique(np.concatenate(parts), return_counts=True)
            size = c.sum()
            often = c > (1 if 4 * size > PORTION else 0)
            total = pd.DataFrame({"h": [0], "c": [size], "total": [True]})
            return pd.concat([total, pd.DataFrame({"h": signed(h[often]), "c": c[often], "total": False})])

        parts, size = [], 0
        for b in batches:
            for t in b["_text"]:
                parts.append(word_hashes(words_of(t, lower=True)))
                size += len(parts[-1])
                if size >= PORTION:
                    yield told(parts)
                    parts, size = [], 0
        if parts:
            yield told(parts)

    counts = stored(
        docs.select("_text").mapInPandas(count, "h long, c long, total boolean")
        .groupBy("h", "total").agg(F.sum("c").alias("c"))
    )
    total = counts.filter("total").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    found = counts.filter((~F.col("total")) & (F.col("c") >= max(16, total // COMMON))).toPandas()
    dropped(counts)
    return pd.Series(found["c"].to_numpy(np.int64), index=found["h"].to_numpy(np.int64)).sort_index()


def sets_of(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """_id, _ref, n, key (identity of the set), bits, and prefix: elements of which a partner shares one.

    Elements are ordered by the count of their rarest word, then by hash. Two
    sets with enough overlap share an element of their prefixes in any order.
    """
    common = common_words(docs)
    shared = docs.sparkSession.sparkContext.broadcast((common.index.to_numpy(), common.to_numpy()))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts = shared.value
        for b in batches:
            rows = []
            for i, ref, t in zip(b["_id"], b["_ref"], b["_text"], strict=True):
                w = word_hashes(words_of(t, lower=True))
                h, at = np.unique(runs_of(w, words), return_index=True)
                n = len(h)
                if not n:
                    rows.append((i, ref, 0, None, None, []))
                    continue
                rank = np.zeros(n, np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, signed(w)), len(known) - 1)
                    seen = np.where(known[place] == signed(w), counts[place], 0)
                    width = min(words, len(w))
                    rank = np.min([seen[j : len(w) - width + 1 + j] for j in range(width)], axis=0)[at]
                take = n - least_overlap(n, percent) + 1
                first = np.lexsort((h, rank))[:take] if rank.any() else np.arange(take)
                key = xxhash.xxh3_128_digest(h.tobytes())
                rows.append((i, ref, n, key, bitmap(h, band_of(n)), signed(h[first])))
            yield pd.DataFrame(rows, columns=["_id", "_ref", "n", "key", "bits", "prefix"])

    return docs.mapInPandas(build, "_id long, _ref string, n long, key binary, bits binary, prefix array<long>")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the likeness asked for, by intersecting sorted arrays of whole texts."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = sieve(docs.select(F.col("_id").alias("id"), F.col("_text").alias("text")), "id", ids)
    left = pairs.join(texts.toDF("a", "text_a"), "a")
    both = left.join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in held:
                if len(held) >= 200:
                    held.clear()
                held[text] = shingles(text, words)
            return held[text]

        for p in batches:
            keep = []
            for ta, tb in zip(p["text_a"], p["text_b"], strict=True):
                sa, sb = of(ta), of(tb)
                same = len(np.intersect1d(sa, sb, assume_unique=True))
                keep.append(100 * same >= percent * (len(sa) + len(sb) - same))
            yield p.loc[keep, ["a", "b"]]

    return both.mapInPandas(exact, "a long, b long")


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps don't rule out."""
    one = sets.select("id", "n", "bits")
    both = pairs.join(one.toDF("a", "n_a", "bits_a"), "a").join(one.toDF("b", "n_b", "bits_b"), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = [
                may_link(na, nb, as_number(ba), as_number(bb), percent)
                for na, nb, ba, bb in zip(p["n_a"], p["n_b"], p["bits_a"], p["bits_b"], strict=True)
            ]
            yield p.loc[keep, ["a", "b"]]

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInPandas(check, "a long, b long")


def tile_pairs(tiles: pd.DataFrame, percent: int, seen: set[tuple[int, int]]) -> pd.DataFrame:
    """Pairs within the tiles, in different classes so far, that places, sizes and bitmaps don't rule out.

    Pairs in `seen` are not told again; it gets the new ones. Rows come by tile and
    size. Row i is compared with row i + 1, then i + 2 and
    so on, for all i at once, as long as that is in the same tile and band. What
    stands before the first element that two sets share is in one of them only;
    `pos` tells how many elements of a set do (0, if the column isn't there).
    """
    t, n, label, ids, home, block, cross, bits = (
        tiles[c].to_numpy() for c in ("t", "n", "label", "id", "home", "block", "cross", "bits"))
    pos = tiles["pos"].to_numpy() if "pos" in tiles else np.zeros(len(t), np.int64)
    _, first, own = np.unique(ids, return_index=True, return_inverse=True)
    codes, held = [np.zeros(0, np.int64)], 0
    i, step = np.arange(len(t) - 1), 1
    while len(i):
        j = i + step
        near = (t[i] == t[j]) & (100 * n[i] >= percent * n[j])
        i, j = i[near], j[near]
        ok = (label[i] != label[j]) & (home[i] | home[j]) & (~cross[i] | (block[i] != block[j]))
        ok &= (100 + percent) * (pos[i] + pos[j]) <= (100 - percent) * (n[i] + n[j])
        x, y = own[i[ok]], own[j[ok]]
        codes.append(np.minimum(x, y) * len(first) + np.maximum(x, y))
        held += len(codes[-1])
        if held > PORTION:
            codes = [np.unique(np.concatenate(codes))]
            held = 0
        step += 1
        i = i[i + step < len(t)]
    numbers: dict[int, tuple[int, int]] = {}
    new: list[tuple[int, int]] = []
    for x, y in zip(*(first[k].tolist() for k in np.divmod(np.unique(np.concatenate(codes)), max(1, len(first)))), strict=True):
        pair = (int(ids[x]), int(ids[y]))
        if pair in seen:
            continue
        for r in (x, y):
            if r not in numbers:
                numbers[r] = as_number(bits[r])
        if may_link(int(n[x]), int(n[y]), numbers[x], numbers[y], percent):
            seen.add(pair)
            new.append(pair)
    return pd.DataFrame(new, columns=["a", "b"], dtype=np.int64)


def live_postings(sets: DataFrame) -> DataFrame:
    """(t, id, n, home, pos): the tiles of each set that another set stands in, one of them at home.

    A tile holds the sets of one size band that share a prefix element; sets
    just above a band visit it as well. pos is the element's place in the set's
    prefix. A bitmap of the shared tiles finds most of the others before they
    are dealt out.
    """
    postings = (
        sets.select("band", F.explode("bands").alias("at"), "prefix")
        .select((F.col("at") == F.col("band")).alias("home"), "at", F.explode("prefix").alias("s"))
        .select(F.col("s").bitwiseXOR(F.shiftleft(F.col("at").cast("long"), TILE_SHIFT)).alias("t"), "home")
    )
    shared = stored(postings.groupBy("t").agg(
        F.count("*").alias("c"), F.max("home").alias("any_home")
    ).filter("c > 1 and any_home").select("t"))
    low = (1 << TILE_BITS) - 1
    marks = sets.sparkSession.sparkContext.broadcast(
        bits_set(shared.select(F.col("t").bitwiseAND(F.lit(low)).alias("p")), TILE_BITS))

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = marks.value
        for b in batches:
            rows = []
            for i, n, band, bands, prefix in zip(b["id"], b["n"], b["band"], b["bands"], b["prefix"], strict=True):
                for at in bands:
                    t = prefix ^ (np.int64(at) << np.int64(TILE_SHIFT))
                    place = t & low
                    pos = np.flatnonzero((held[place >> 6] >> (place & 63)) & 1)
                    if len(pos):
                        rows.append((i, n, at == band, t[pos], pos))
            yield pd.DataFrame(rows, columns=["id", "n", "home", "t", "pos"])

    found = (
        sets.select("id", "n", "band", "bands", "prefix")
        .mapInPandas(kept, "id long, n long, home boolean, t array<long>, pos array<long>")
        .select("id", "n", "home", F.explode(F.arrays_zip("t", "pos")).alias("p"))
        .select("p.t", "id", "n", "home", "p.pos")
    )
    live = stored(found.join(shared, "t"))
    marks.destroy()
    dropped(shared)
    return live


def links(docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) between sets (id, n, bits, prefix; all different): enough links for the same components.

    First every set is compared with one leader of its tiles only. What this
    connects needs no further comparing, so a group of near copies is not paired
    with itself. Then the sets of a tile that are not yet connected are compared
    by their bitmaps, and what the bounds leave is verified. No pair is capped.

    Near copies share many tiles. All open tiles with the same smallest class
    are compared in one piece, so that a set comes there once, with its bitmap
    and the list of its tiles, and a pair is told once, not for each tile. Large
    pieces are cut into blocks that meet two by two.
    """
    band = F.greatest(F.lit(5), F.ceil(F.log2(F.col("n").cast("double")))).cast("int")
    lower = F.col("n") * percent <= F.pow(F.lit(2.0), F.col("band") - 1) * 100
    bands = F.when(lower & (F.col("band") > 5), F.array("band", F.col("band") - 1)).otherwise(F.array("band"))
    live = live_postings(sets.withColumn("band", band).withColumn("bands", bands))

    narrow = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100)))
    near = live.withColumn("sub", narrow)
    leaders = near.groupBy("t", "sub").agg(F.min("id").alias("lead"), F.count("*").alias("m")).filter("m > 1")
    stars = stored(
        near.join(leaders, ["t", "sub"]).filter("id <> lead").groupBy("id", "lead").agg(F.count("*").alias("m"))
        .groupBy("id").agg(F.max_by("lead", F.struct("m", -F.col("lead"))).alias("lead"))
        .select("id", F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    )
    tried = stored(stars.select("a", "b").distinct())
    first = stored(verified(bounded(tried, sets, percent), docs, words, percent))
    found = stored(components(first))

    named = (
        live.join(found, "id", "left").withColumn("label", F.coalesce("component", "id"))
        .join(stars, "id", "left").withColumn("pair", F.when(F.col("a").isNotNull(), F.struct("a", "b")))
    )
    # a tile of two sets is settled if they were compared
    two = F.struct(F.min("id").alias("a"), F.max("id").alias("b"))
    open_tiles = named.groupBy("t").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("pos").alias("least"), F.count("*").alias("c"),
        (F.coalesce(F.min("pair") == two, F.lit(False)) | F.coalesce(F.max("pair") == two, F.lit(False))).alias("settled"),
    ).filter("lo <> hi and not (c = 2 and settled)").select("t", "lo", "least")
    # the largest partner is 100 / percent times as large
    reach = (100 - percent) * F.col("n") >= percent * (F.col("pos") + F.col("least"))
    standing = stored(
        named.join(open_tiles, "t").filter(reach).select("lo", "id", "n", "label", "t", "home", "pos")
        .repartition("id").groupBy("id", "lo").agg(
            F.first("n").alias("n"), F.first("label").alias("label"), F.collect_list(F.struct("t", "home", "pos")).alias("at"))
        .select("id", "lo", "n", "label", F.col("at.t").alias("t"), F.col("at.home").alias("home"), F.col("at.pos").alias("pos"))
    )
    # as many rows at most as there are blocks
    large = standing.groupBy("lo").agg(F.count("*").alias("c")).filter(F.col("c") > BLOCK)
    blocks = F.coalesce(F.ceil(F.col("c") / BLOCK), F.lit(1)).cast("int")
    rest = (
        standing.join(sets.select("id", "bits"), "id").join(F.broadcast(large), "lo", "left").withColumn("k", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .withColumn("piece", F.xxhash64("lo", F.least("block", "other"), F.greatest("block", "other")))
        # a row that meets its own block stands in that block's piece only
        .withColumn("cross", F.col("block") != F.col("other"))
        .select("piece", "id", "n", "label", "block", "cross", "bits", "t", "home", "pos")
        .repartition(F.col("piece")).sortWithinPartitions("piece")
    )

    def tiles_of(rows: pd.DataFrame) -> pd.DataFrame:
        """A row for each tile of each row, by piece, tile and size."""
        many = rows["t"].map(len).to_numpy()
        out = rows.loc[rows.index.repeat(many), ["piece", "id", "n", "label", "block", "cross", "bits"]]
        at = {c: np.concatenate(rows[c].to_numpy()) for c in ("t", "home", "pos")}
        order = np.lexsort((out["id"], out["n"], at["t"], out["piece"]))
        out = out.assign(**at).iloc[order]
        # the tiles are numbered, as two pieces may share one
        new = (out["t"].to_numpy()[1:] != out["t"].to_numpy()[:-1]) | (out["piece"].to_numpy()[1:] != out["piece"].to_numpy()[:-1])
        return out.assign(t=np.concatenate([[0], np.cumsum(new)]))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, seen = None, set()
        for b in itertools.chain(batches, [None]):
            now = held if b is None else b if held is None else pd.concat([held, b], ignore_index=True)
            if now is None or not len(now):
                continue
            piece = now["piece"].to_numpy()
            whole = len(now) if b is None else int(np.searchsorted(piece == piece[-1], True))
            if whole:
                if len(seen) > KNOWN_PAIRS:
                    seen.clear()
                yield tile_pairs(tiles_of(now.iloc[:whole]), percent, seen)
            held = None if b is None else now.iloc[whole:].reset_index(drop=True)

    pairs = rest.mapInPandas(compare, "a long, b long")
    # stored first: the optimizer would join before it makes the pairs distinct
    told = stored(pairs.distinct())
    pairs = stored(told.join(tried, ["a", "b"], "left_anti"))
    for done in (live, stars, tried, found, standing, told):
        dropped(done)
    out = stored(first.union(verified(pairs, docs, words, percent)))
    dropped(first)
    dropped(pairs)
    return out


def without_ids(built: DataFrame) -> tuple[DataFrame, int] | None:
    """(key, ref, sid) of the sets that only rows without an id have, and the least sid; None without such sets.

    ref tells one of the set's texts, and sid is a number beyond all ids, which
    stands for the missing one.
    """
    named = built.filter("n > 0 and _id is not null")
    lone = built.filter("n > 0 and _id is null")
    if lone.isEmpty():
        return None
    least = max(0, named.agg(F.max("_id")).first()[0] or 0) + 1
    alone = lone.groupBy("key").agg(F.min("_ref").alias("ref")).join(named.select("key"), "key", "left_anti")
    return stored(alone.withColumn("sid", F.monotonically_increasing_id() + least)), least


def classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """_id, _ref, n, component, leads of every row of docs(_id, _text).

    Rows without an id take part under a number of their own. Where no row of a
    component has an id, component is null, and one text of it leads: its _ref
    is told by leads.
    """
    with settings(docs.sparkSession, SMALL_BATCHES | FREED_SHUFFLES):
        return _classes(docs, words, percent)


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    docs = docs.withColumn("_ref", F.when(F.col("_id").isNull(), F.md5("_text")))
    built = stored(sets_of(docs, words, percent))
    alone = without_ids(built)
    named = built.filter("n > 0 and _id is not null").drop("_ref")
    texts = docs.filter("_id is not null").select("_id", "_text")
    if alone is not None:
        lone, least = alone
        one = built.filter("n > 0 and _id is null").join(lone, "key").filter("_ref = ref").dropDuplicates(["key"])
        named = named.unionByName(one.select(F.col("sid").alias("_id"), "n", "key", "bits", "prefix"))
        # equal texts of a null id are one text here
        told = docs.filter("_id is null").join(lone, F.col("_ref") == F.col("ref")).dropDuplicates(["sid"])
        texts = texts.unionByName(told.select(F.col("sid").alias("_id"), "_text"))
    same = stored(named.groupBy("key").agg(F.min("_id").alias("rep")))
    reps = same.withColumnRenamed("key", "_k")
    # copies are few, so their ids are looked for without dealing out all the sets
    copies = stored(named.select("key", "_id").join(reps, (F.col("key") == F.col("_k")) & (F.col("_id") != F.col("rep")))
                    .select(F.col("_id").alias("id"), F.col("key").alias("_copy")))
    given = with_may_be_in(
        named.select(F.col("_id").alias("id"), "n", "bits", "prefix", "key"), "id", copies.select("id"), "_may")
    doubtful = given.filter("_may").join(
        copies.withColumnRenamed("id", "_copy_id"), (F.col("id") == F.col("_copy_id")) & (F.col("key") == F.col("_copy")),
        "left_anti").dropDuplicates(["id", "key"])
    sets = given.filter("not _may").unionByName(doubtful).select("id", "n", "bits", "prefix")
    found = components(links(texts, sets, words, percent))
    named = same.join(found.toDF("rep", "component"), "rep", "left").select(
        F.col("key").alias("_k"), F.coalesce("component", "rep").alias("component")
    )
    rows = built.select("_id", "_ref", "n", "key").join(named, F.col("key") == F.col("_k"), "left").drop("_k")
    rows = rows.withColumn("component", F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component")))
    if alone is None:
        return rows.select("_id", "_ref", "n", "component", F.lit(False).alias("leads"))
    lead = lone.select(F.col("sid").alias("_s"), "ref")
    return rows.join(lead, F.col("component") == F.col("_s"), "left").select(
        "_id", "_ref", "n", F.when(F.coalesce(F.col("component"), F.lit(0)) < least, F.col("component")).alias("component"),
        F.coalesce(F.col("_ref") == F.col("ref"), F.lit(False)).alias("leads"),
    )


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id.

    Words are lower-cased (A-Z) and end at the six ASCII blanks. A set has the
    distinct runs of `words` words; a shorter text is one run; a null, empty or
    blank text has none, and stands alone. Two documents link if 100 times the
    size of their intersection is at least `percent` times that of their union,
    and component_id is the smallest id reachable. Equal sets are compared once.
    Rows that share an id are one node of the links: what either of their texts
    is linked with is one component. Rows without an id link as others do;
    component_id is null where no row of a component has one.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    return classes(given, words, percent).select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest id of their component, with all columns.

    Equal rows of one id stay once. Rows without an id go where their component
    has one; where it has none, one of its rows stays. Those without words stay.
    Only rows that may go are shuffled.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    found = stored(classes(given, words, percent))
    gone = found.filter("_id <> component").select(F.col("_id").alias("_cl_gone")).distinct()
    again = found.groupBy("_id").agg(F.count("*").alias("c")).filter("c > 1 and _id is not null")
    suspects = gone.select(F.col("_cl_gone").alias("_cl_id")).union(again.select("_id"))
    numbered = docs.withColumn("_cl_id", F.col("doc_id").cast("long"))
    known = with_may_be_in(numbered.filter("_cl_id is not null"), "_cl_id", suspects, "_cl_may")
    doubtful = known.filter("_cl_may").join(gone, F.col("_cl_id") == F.col("_cl_gone"), "left_anti")
    rest = known.filter("not _cl_may").unionByName(doubtful.dropDuplicates(["_cl_id", "text"])).select(*docs.columns)
    if found.filter("_id is null").isEmpty():
        return rest
    without = numbered.filter("_cl_id is null").withColumn("_cl_ref", F.md5("text"))
    empty = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) == 0
    leads = found.filter("_id is null and leads").select(F.col("_ref").alias("_cl_ref")).distinct()
    one = without.filter(~empty).join(leads, "_cl_ref", "left_semi").dropDuplicates(["_cl_ref"])
    return rest.unionByName(without.filter(empty).select(*docs.columns)).unionByName(one.select(*docs.columns))


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END)) AS s FROM words),
reps AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS g FROM reps),
pairs AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep),
links AS (SELECT a, b FROM pairs WHERE 100 * k >= 85 * (na + nb - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, low) AS (
  SELECT rep, rep FROM reps UNION SELECT b.b, r.low FROM reach r JOIN both_ways b ON r.id = b.a AND r.low < b.b),
lowest AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
SELECT x.doc_id, len(x.s)::BIGINT AS n_shingles, coalesce(l.component_id, x.doc_id) AS component_id
FROM sets x LEFT JOIN reps r ON r.s = x.s LEFT JOIN lowest l ON l.id = r.rep
"""


@query("op1_ngram_jaccard_join", OP1_SQL)
def op1_ngram_jaccard_join(spark, sf):
    return jaccard_components(table(spark, sf, "documents"), words=4, percent=85)
