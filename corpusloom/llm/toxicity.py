"""Toxicity: how much shorter a text's windows get by a zstandard dictionary trained on toxic text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import columns_of, held_out, labelled_sample, query, table

# Bounds of the sample that dictionaries and thresholds are fitted on: rows of label 0 and 1, characters of a row.
SAMPLE_ROWS = (4_000, 2_000)
SAMPLE_CHARS = 20_000

WINDOW, STEP = 64, 48  # bytes of a window, and from one window's start to the next one's
ORDINARY_BYTES, TOXIC_BYTES = 112 * 1024, 4 * 1024  # of the dictionaries, at most
RECUR = 0.01  # words that a word of the toxic dictionary follows, for each toxic text, at least
GAINS = np.arange(1, 9)  # thresholds: bytes that a window is shorter by
PORTION = 1 << 20  # bytes of text whose windows are compressed at once


def raw_text(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of the windows over texts that follow each other, and each text's first window.

    Windows overlap and cover every byte; an empty text has one empty window.
    """
    starts = np.cumsum(lengths) - lengths
    counts = np.maximum(1, -(-(lengths - (WINDOW - STEP)) // STEP))
    first = np.cumsum(counts) - counts
    nth = np.arange(counts.sum()) - np.repeat(first, counts)
    at = np.repeat(starts, counts) + nth * STEP
    return at, np.minimum(at + WINDOW, np.repeat(starts + lengths, counts)) - at, first


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Finds matches anywhere in the content. Fixed parameters: lengths differ by what the dictionaries hold only."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=4, target_length=32,
        strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=held)


def compressed_lengths(by: zstandard.ZstdCompressor, raw: bytes, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    told = np.stack([at, length], 1).astype("<u8").tobytes()
    made = by.multi_compress_to_buffer(zstandard.BufferWithSegments(raw, told), threads=0)
    return np.fromiter(map(len, made), np.int64, len(made))


def dictionary(samples: list[bytes], size: int, pieces: tuple[int, ...], after: bytes = b"") -> bytes:
    """Trained on the samples, at most `size` bytes; too few to train on are taken as they are.

    The trainer joins pieces of a given length, and which length does best
    depends on the samples: that whose dictionary, with `after` behind it, makes
    them shortest is taken.
    """
    made = []
    for piece in pieces:
        try:
            made.append(zstandard.train_dictionary(size, samples, k=piece, d=6).as_bytes())
        except zstandard.ZstdError:
            continue
    if not made:
        made = [b"".join(dict.fromkeys(samples))[-size:]]
    if len(made) == 1:
        return made[0]
    length = np.array([len(x) for x in samples], np.int64)
    raw, at = b"".join(samples), np.cumsum(length) - length
    return min(made, key=lambda x: int(compressed_lengths(compressor(x + after), raw, at, length).sum()))


class Dictionaries:
    """A dictionary of ordinary text and one of toxic text, and the gain of a window by the second.

    Both are trained apart. A window is compressed with the ordinary one alone
    and with the toxic one before it, so that ordinary words cost the same in
    both and only what the toxic dictionary alone explains makes a difference.
    The toxic one is trained on words that recur in toxic texts and that the
    ordinary sample never shows, since dictionaries of both whole texts differ
    mostly by chance. A word recurs as often as it follows different words, so
    that copies of one text count once.
    """

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]) -> None:
        at, length, _ = windows_of(np.array([len(t) for t in ordinary], np.int64))
        raw = b"".join(ordinary)
        parts = [raw[a : a + n] for a, n in zip(at.tolist(), length.tolist(), strict=True) if n]
        self.ordinary = dictionary(parts[:: -(-len(parts) // 50_000)] if parts else [], ORDINARY_BYTES, (16,))
        known = {w for t in ordinary for w in t.split()}
        words = [t.split() for t in toxic]
        # in the order of the texts, not by word: the trainer looks for the best piece of each stretch
        told = dict.fromkeys((w, before) for t in words for before, w in zip([b"", *t], t, strict=False) if w not in known)
        often = Counter(w for w, _ in told)
        least = max(2, RECUR * len(toxic))
        self.toxic = dictionary(
            [b" " + w for w, _ in told if often[w] >= least], TOXIC_BYTES, (16, 24, 32, 48, 64, 96), self.ordinary)
        self.weights = np.zeros(len(GAINS) + 2)

    def prepared(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return compressor(self.ordinary), compressor(self.toxic + self.ordinary)

    def counted(self, texts: list[bytes], both: tuple | None = None) -> np.ndarray:
        """For each text, its windows whose gain reaches each of GAINS, all its windows, and its largest gain."""
        plain, extended = both or self.prepared()
        out = np.zeros((len(texts), len(GAINS) + 2), np.int64)
        begin = 0
        while begin < len(texts):  # a text beyond a portion is one of its own
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= PORTION):
                size += len(texts[end])
                end += 1
            lengths = np.array([len(t) for t in texts[begin:end]], np.int64)
            at, length, first = windows_of(lengths)
            raw, gain = b"".join(texts[begin:end]), np.zeros(len(at), np.int64)
            for a in range(0, len(at), 1 << 16):
                some = a + np.flatnonzero(length[a : a + (1 << 16)])
                if len(some):
                    gain[some] = compressed_lengths(plain, raw, at[some], length[some]) - compressed_lengths(
                        extended, raw, at[some], length[some])
            for i, g in enumerate(GAINS):
                out[begin:end, i] = np.add.reduceat((gain >= g).astype(np.int64), first)
            out[begin:end, -2] = np.diff(np.append(first, len(at)))
            out[begin:end, -1] = np.maximum.reduceat(gain, first)
            begin = end
        return out

    @staticmethod
    def features(counts: np.ndarray) -> np.ndarray:
        """Logarithms of the counts, and a one."""
        known = np.log1p(counts[:, :-1].astype(float))
        known[:, -1] /= 4
        return np.concatenate([known, np.ones((len(counts), 1))], 1)

    def calibrate(self, counts: np.ndarray, y: np.ndarray, prior: float) -> None:
        """What the counts at each threshold are worth: ridge logistic regression, shifted to the share of label 1."""
        x, w = self.features(counts), np.zeros(len(GAINS) + 2)
        weight = np.where(y == 1, prior / max(1e-9, y.mean()), (1 - prior) / max(1e-9, 1 - y.mean()))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.3 * np.eye(len(w))
            w = w - np.linalg.solve(bend, x.T @ (weight * (p - y)) + 0.3 * w)
        self.weights = w

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-np.clip(self.features(counts) @ self.weights, -30, 30))), 5)


def fitted(docs: DataFrame, labels: DataFrame) -> Dictionaries | float:
    """Dictionaries and thresholds, or the smoothed share of label 1 where the labels don't show both values.

    Thresholds are calibrated on windows that the dictionaries have not seen:
    each third of the sample, by its content, is counted with dictionaries of
    the other two. The dictionaries returned are trained on all of it.
    """
    rows, have = labelled_sample(
        docs, labels, "toxic", ~held_out(F.col("_id"), 5, 0), SAMPLE_ROWS, SAMPLE_CHARS)
    share = (have.get(1, 0) + 1) / (sum(have.values()) + 2)
    texts, y = [raw_text(text) for _, text, _ in rows], np.array([label for _, _, label in rows], np.int64)
    if not 0 < y.sum() < len(y):
        return share
    third = np.array([sum(t[:64]) % 3 for t in texts])

    def of(use: np.ndarray) -> Dictionaries:
        toxic, ordinary = ([texts[i] for i in np.flatnonzero(use & (y == label))] for label in (1, 0))
        return Dictionaries(toxic, ordinary)

    counts = np.zeros((len(texts), len(GAINS) + 2), np.int64)
    for part in np.unique(third):
        counts[third == part] = of(third != part).counted([texts[i] for i in np.flatnonzero(third == part)])
    model = of(np.ones(len(y), bool))
    model.calibrate(counts, y, share)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from `threshold` on), windows, largest_gain.

    Windows of WINDOW bytes cover the whole text, however long, and overlap. Case
    plays no part. A null text counts as an empty one, of one empty window; a
    null id is never held out; repeated rows get the same score. Labels that are
    null, neither 0 nor 1, or contradict each other for an id are not used; with
    fewer than two label values left, every score is the smoothed share of label
    1 and the last two columns are null. Other columns of docs play no part.
    """
    model = fitted(docs, labels)
    rows = columns_of(docs, "doc_id", "text")
    if isinstance(model, float):
        found = rows.select("doc_id", F.lit(model).alias("score"), F.lit(None).cast("long").alias("windows"),
                            F.lit(None).cast("long").alias("largest_gain"))
    else:
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            both = model.prepared()
            for b in batches:
                counts = model.counted([raw_text(t) for t in b["text"]], both)
                yield pd.DataFrame({
                    "doc_id": b["doc_id"], "score": model.scores(counts), "windows": counts[:, -2],
                    "largest_gain": counts[:, -1]})

        kind = rows.schema["doc_id"].dataType.simpleString()
        found = rows.mapInPandas(score, f"doc_id {kind}, score double, windows long, largest_gain long")
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "windows", "largest_gain",
    )


@query("op11_toxicity")
def op11_toxicity(spark, sf):
    return toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
