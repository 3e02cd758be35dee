"""SentencePiece encoding with seeded merge-dropout, and lossless decoding."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import mix, query, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
PORTION = 60_000  # symbols merged at once
LONG = 400  # a segment with more symbols uses a heap of its own
NONE = np.int64(1 << 30)  # no merge; ranks are below


class PieceModel:
    """Pieces, their order as merges, and their bytes.

    Differs from the library in one point, without which decoding loses text: a
    space mark that the text itself holds is spelt in byte pieces.
    """

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        """pieces: (piece, score, kind) by id; kind is normal, byte or other."""
        self.size = len(pieces)
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        self.byte_ids = np.full(256, -1, np.int32)
        self.raw = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            else:
                self.raw.append(p.replace(SPACE_MARK, " ").encode() if kind == "normal" else b"")
        self.points = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.points[ord(p)] = i
        self.mark = normal[SPACE_MARK]
        self.points[0x20], self.points[ord(SPACE_MARK)] = self.mark, -1
        scores = np.array([s for _, s, _ in pieces])
        self.order = np.empty(self.size, np.int64)
        self.order[np.lexsort((np.arange(self.size), -scores))] = np.arange(self.size)
        made = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                if p[:cut] in normal and p[cut:] in normal:
                    made[normal[p[:cut]] * self.size + normal[p[cut:]]] = i
        # no merge joins a space mark to what stands before it, so words are merged apart
        self.by_word = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in normal)
        self.slots = np.uint64(max(4, int(4 * len(made)).bit_length()))
        self.keys = np.full((1 << int(self.slots)) + 64, -1, np.int64)
        self.made = np.full(len(self.keys), -1, np.int64)
        self.probes = 1
        for k, i in made.items():
            at = int(self._slot(np.array([k]))[0])
            first = at
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.made[at] = k, i
            self.probes = max(self.probes, at - first + 1)

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if p.is_byte(i):
                return "byte"
            return "other" if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else "normal"

        return cls([(p.id_to_piece(i), p.get_score(i), kind(i)) for i in range(p.get_piece_size())])

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> (np.uint64(64) - self.slots)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces make together, or -1."""
        k = left.astype(np.int64) * self.size + right
        at = self._slot(k)
        held = self.keys[at]
        out = np.full(len(k), -1)
        hit = held == k
        out[hit] = self.made[at[hit]]
        more = np.flatnonzero(~hit & (held >= 0))
        for step in range(1, self.probes):
            if not len(more):
                break
            held = self.keys[at[more] + step]
            hit = held == k[more]
            out[more[hit]] = self.made[at[more[hit]] + step]
            more = more[~hit & (held >= 0)]
        return out

    # --- encoding ---------------------------------------------------------------

    def symbols(self, text: str) -> np.ndarray:
        """A space mark and the text's characters as pieces; others as the bytes of their UTF-8."""
        points = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids = self.points[points]
        other = np.flatnonzero(ids < 0)
        if not len(other):
            return ids
        spelt = [self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in points[other]]
        count = np.ones(len(ids), np.int64)
        count[other] = [len(x) for x in spelt]
        out = np.repeat(ids, count)
        out[np.repeat(ids < 0, count)] = np.concatenate(spelt)
        return out

    @staticmethod
    def skipped(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
        """Whether the candidate merge of [start, mid) with [mid, end) is skipped in the text with this key."""
        h = mix(key + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        h = mix(h + mid.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        h = mix(h + end.astype(np.uint64))
        return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < rate

    def encode(self, texts: list[str], keys: np.ndarray, rate: float = 0.0) -> list[np.ndarray]:
        """Piece ids of each text. The best candidate merges first, of equals the leftmost.

        A candidate is skipped for good when its keyed hash is below `rate`;
        that depends on the text's key and on where the candidate stands, so a
        text is segmented alike wherever and whenever it is encoded.
        """
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0

        def flush() -> None:
            nonlocal held, size
            if held:
                sym = np.concatenate([s for _, s, _ in held])
                at = np.concatenate([np.arange(a, a + len(s)) for _, s, a in held])
                owner = np.repeat([i for i, _, _ in held], [len(s) for _, s, _ in held])
                first = np.empty(len(sym), bool)
                first[:] = at == 0
                if self.by_word:
                    first[1:] |= (sym[1:] == self.mark) & (sym[:-1] != self.mark)
                first[np.cumsum([0] + [len(s) for _, s, _ in held[:-1]])] = True
                ids, where = self._merge(sym, at, keys[owner], first, rate)
                ends = np.cumsum([len(s) for _, s, _ in held])
                for (i, _, _), part in zip(held, np.split(ids, np.searchsorted(where, ends[:-1])), strict=True):
                    out[i].append(part)
            held, size = [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            sym = self.symbols(text)
            a = 0
            while a < len(sym):
                z = len(sym)
                if self.by_word and z - a > PORTION:  # cut where a word begins
                    starts = np.flatnonzero((sym[a + PORTION :] == self.mark) & (sym[a + PORTION - 1 : -1] != self.mark))
                    z = a + PORTION + int(starts[0]) if len(starts) else z
                held.append((i, sym[a:z], a))
                size += z - a
                a = z
                if size >= PORTION:
                    flush()
        flush()
        return [np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in out]

    def _candidates(self, left, right, start, mid, end, key, rate) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours; NONE where they don't merge, or not this time."""
        made = self.merged(left, right)
        rank = np.where(made >= 0, self.order[made], NONE)
        if rate > 0:
            t = np.flatnonzero(made >= 0)
            rank[t[self.skipped(key[t], start[t], mid[t], end[t], rate)]] = NONE
        return rank, made

    def _merge(self, sym, at, key, first, rate) -> tuple[np.ndarray, np.ndarray]:
        """Final pieces of all segments, and the places of their first symbols.

        Symbols are linked to their neighbours, and every round merges the best
        candidate of each segment that has one, found as a minimum per segment.
        """
        n = len(sym)
        sym = sym.astype(np.int64)
        begins = np.flatnonzero(first)
        lens = np.diff(np.append(begins, n))
        for s in np.flatnonzero(lens > LONG):
            part = slice(begins[s], begins[s] + lens[s])
            self._merge_long(sym[part], at[part], key[part], rate)
        after = np.arange(1, n + 1)
        after[begins + lens - 1] = n  # no neighbour
        before = np.arange(-1, n - 1)
        before[begins] = n
        end = np.append(at + 1, 0)
        before = np.append(before, n)
        best = np.full(n + 1, NONE << 32)  # rank and place; the last is a stand-in
        made = np.full(n + 1, -1)
        inner = np.repeat(lens <= LONG, lens)
        inner[begins + lens - 1] = False
        i = np.flatnonzero(inner)
        r, made[i] = self._candidates(sym[i], sym[i + 1], at[i], at[i + 1], end[i + 1], key[i], rate)
        best[i] = (r << 32) | i
        # the rows that still change stand together in `row`, those of a segment from its begin on
        row, begin = np.arange(n), begins
        while len(row):
            low = np.minimum.reduceat(best[row] if len(row) < n else best[:-1], begin)
            alive = low < (NONE << 32)
            if not alive.any():
                break
            i = low[alive] & 0xFFFFFFFF
            j = after[i]
            sym[i], end[i] = made[i], end[j]
            sym[j] = -1
            best[j] = NONE << 32
            after[i] = after[j]
            before[after[j]] = i
            before[n] = n
            best[i] = NONE << 32
            right = i[after[i] < n]
            left = before[i]
            left = left[left < n]
            x = np.concatenate((left, right))
            y = after[x]
            r, made[x] = self._candidates(sym[x], sym[y], at[x], at[y], end[y], key[x], rate)
            best[x] = np.where(r < NONE, (r << 32) | x, NONE << 32)
            if alive.mean() < 0.7:  # leave out the segments that are done
                size = np.diff(np.append(begin, len(row)))
                row = row[np.repeat(alive, size)]
                size = size[alive]
                begin = np.cumsum(size) - size
        where = np.flatnonzero(sym >= 0)
        return sym[where], where

    def _merge_long(self, sym, start, key, rate) -> None:
        """The same for one long segment, in place, with an agenda: n log n steps, not n squared."""
        n = len(sym)
        end = start + 1
        before, after = np.arange(-1, n - 1).tolist(), np.arange(1, n + 1).tolist()
        rank, made = self._candidates(sym[:-1], sym[1:], start[:-1], start[1:], end[1:], key[:-1], rate)
        agenda = [(int(rank[i]), i, i + 1, int(start[i]), int(end[i + 1]), int(made[i]))
                  for i in np.flatnonzero(rank < NONE)]
        heapq.heapify(agenda)
        gone = [False] * n
        ends, ids = end.tolist(), sym.tolist()

        def push(i: int, j: int) -> None:
            if i < 0 or j >= n:
                return
            m = int(self.merged(np.array([ids[i]]), np.array([ids[j]]))[0])
            if m >= 0 and not (rate > 0 and self.skipped(
                    key[:1], start[i : i + 1], start[j : j + 1], np.array([ends[j]]), rate)[0]):
                heapq.heappush(agenda, (int(self.order[m]), i, j, int(start[i]), ends[j], m))

        while agenda:
            _, i, j, _, e, m = heapq.heappop(agenda)
            if gone[i] or gone[j] or after[i] != j or ends[j] != e or int(start[j]) != ends[i]:
                continue
            ids[i], ends[i], gone[j] = m, e, True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        sym[:] = np.where(gone, -1, ids)

    # --- decoding ---------------------------------------------------------------

    def decode(self, ids) -> str:
        raw = b"".join([self.raw[i] for i in ids])
        return raw[1:].decode("utf-8", "surrogatepass") if raw[:1] == b" " else raw.decode("utf-8", "surrogatepass")


def text_key(doc_id: object, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=seed)


def shared_model(spark: SparkSession, path: str):
    """The model for all tasks; read on the driver only, and as large as its vocabulary."""
    return spark.sparkContext.broadcast(PieceModel.load(path))


def encoded(docs: DataFrame, path: str = MODEL, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, ids (piece ids), n_pieces, decoded_sha256, lossless.

    Whole texts, whatever they hold: what the vocabulary lacks is spelt in
    bytes, and decoding gives the text back. A null text has null ids and
    digest, and counts as lossless; an empty one has no pieces. The seed and
    the id pick the segmentation, so repeated rows are segmented alike.
    """
    model = shared_model(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            for a in range(0, len(b), 1_000):
                part = b.iloc[a : a + 1_000]
                texts = [None if t is None else t for t in part["text"]]
                keys = np.array([text_key(i, seed) for i in part["_key"]], np.uint64)
                ids = m.encode([t or "" for t in texts], keys, rate)
                back = [m.decode(x.tolist()) for x in ids]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"],
                    "ids": pd.Series([None if t is None else x for t, x in zip(texts, ids, strict=True)],
                                     index=part.index, dtype=object),
                    "n_pieces": [len(x) for x in ids],
                    "decoded_sha256": [None if t is None else hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                                       for t, s in zip(texts, back, strict=True)],
                    "lossless": [t is None or t == s for t, s in zip(texts, back, strict=True)],
                })

    kind = dict(docs.dtypes)["doc_id"]
    given = docs.select("doc_id", F.col("doc_id").cast("string").alias("_key"), "text")
    return given.mapInPandas(
        run, f"doc_id {kind}, ids array<int>, n_pieces long, decoded_sha256 string, lossless boolean"
    )


@query("op8_sentencepiece")
def op8_sentencepiece(spark, sf):
    return encoded(table(spark, sf, "documents"))
