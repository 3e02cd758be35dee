"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import columns_of, held_out, labelled_sample, query, table

# Bounds of the sample that the network is fitted on: rows of each label, characters of a row.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 20_000

BLOCK = 4  # bytes a filter moves by; a filter sees two blocks
GROUP = 16  # blocks pooled together first
CHUNK = 8  # groups of a chunk; chunks overlap by one group
DIM, FILTERS, HIDDEN = 4, 24, 12
BATCH_BYTES = 1 << 18  # its arrays take about 70 times as many bytes, and a worker keeps them


class Network:
    """Bytes -> embedding -> filters -> maximum per chunk -> chunk logit -> one probability.

    The document's logit is a learned combination of the mean, the least and the
    largest logit of its chunks, and the chunks cover every byte.
    """

    def __init__(self, seed: int = 0) -> None:
        r = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {
            "emb": draw(256, DIM) * 16,
            "conv": draw(2, BLOCK * DIM, FILTERS),
            "bias": np.zeros(FILTERS, np.float32),
            "w1": draw(FILTERS, HIDDEN),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": draw(HIDDEN, 1)[:, 0],
            "mixed": np.array([0.5, 0.5, 0.0, 0.0], np.float32),
        }
        self.shift = 0.0

    @staticmethod
    def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in one array, each padded with zeros to whole groups, and its group count."""
        width = BLOCK * GROUP
        groups = np.array([len(t) // width + 1 for t in texts], np.int64)
        padded = b"".join(t.ljust(int(g) * width, b"\0") for t, g in zip(texts, groups, strict=True))
        return np.frombuffer(padded, np.uint8), groups

    def pooled(self, raw: np.ndarray, groups: np.ndarray) -> tuple:
        """Maxima of the filters per group, and what the training needs of them."""
        x = self.p["emb"][raw].reshape(-1, BLOCK * DIM)
        out = x @ self.p["conv"][0]
        out[:-1] += (x @ self.p["conv"][1])[1:]
        out += self.p["bias"]
        out[np.cumsum(groups) * GROUP - 1] = -np.inf  # there the filter would see the next text
        return x, out.reshape(-1, GROUP, FILTERS)

    @staticmethod
    def chunks(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group numbers of every chunk, and the first chunk of every text."""
        step = CHUNK - 1
        counts = np.maximum(1, -(-(groups - 1) // step))
        ends = np.cumsum(groups)
        first = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
        nth = np.arange(counts.sum()) - np.repeat(first, counts)
        start = np.repeat(ends - groups, counts) + nth * step
        return np.minimum(start[:, None] + np.arange(CHUNK), np.repeat(ends - 1, counts)[:, None]), first

    def heads(self, f: np.ndarray, first: np.ndarray) -> tuple:
        hidden = f @ self.p["w1"] + self.p["b1"]
        logit = np.maximum(hidden, 0) @ self.p["w2"]
        counts = np.diff(np.append(first, len(logit)))
        mean = np.add.reduceat(logit, first) / counts
        stats = np.stack([mean, np.minimum.reduceat(logit, first), np.maximum.reduceat(logit, first)], 1)
        return hidden, logit, counts, stats, stats @ self.p["mixed"][:3] + self.p["mixed"][3]

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Of each text, in portions of bounded size. A text beyond that goes alone, group by group."""
        out = np.zeros(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_BYTES):
                size += len(texts[end])
                end += 1
            raw, groups = self.lay_out(texts[at:end])
            idx, first = self.chunks(groups)
            best = self.maxima(raw, groups)
            out[at:end] = self.heads(np.maximum(best[idx].max(1), 0), first)[-1]
            at = end
        return out + self.shift

    def maxima(self, raw: np.ndarray, groups: np.ndarray) -> np.ndarray:
        width, portion = BLOCK * GROUP, BATCH_BYTES
        if len(raw) <= 2 * portion:
            return self.pooled(raw, groups)[1].max(1)
        parts = []
        for a in range(0, len(raw), portion):  # one group more on the right, as the filters look ahead
            part = raw[a : a + portion + width]
            more = a + portion < len(raw)
            parts.append(self.pooled(part, np.array([len(part) // width]))[1].max(1)[: -1 if more else None])
        return np.concatenate(parts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities, rounded to what doesn't depend on which texts are scored together."""
        return np.round(1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30))), 5)

    # --- training -------------------------------------------------------------

    def gradients(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        raw, groups = self.lay_out(texts)
        x, out = self.pooled(raw, groups)
        idx, first = self.chunks(groups)
        spread = out.reshape(-1, GROUP, FILTERS)
        best, arg = spread.max(1), spread.argmax(1)
        among = best[idx]
        which = among.argmax(1)
        f = np.take_along_axis(among, which[:, None], 1)[:, 0]
        hidden, logit, counts, stats, z = self.heads(np.maximum(f, 0), first)
        dz = (1 / (1 + np.exp(-z)) - y) / len(y)
        g = {"mixed": np.append(dz @ stats, dz.sum())}
        owner = np.repeat(np.arange(len(y)), counts)
        m = self.p["mixed"]
        share = m[0] / counts[owner] + m[1] * (logit == stats[owner, 1]) + m[2] * (logit == stats[owner, 2])
        dl = dz[owner] * share
        g["w2"] = dl @ np.maximum(hidden, 0)
        dh = dl[:, None] * self.p["w2"] * (hidden > 0)
        act = np.maximum(f, 0)
        g["w1"], g["b1"] = act.T @ dh, dh.sum(0)
        df = dh @ self.p["w1"].T * (f > 0)
        g["bias"] = df.sum(0)
        group = np.take_along_axis(idx, which, 1)
        block = group * GROUP + arg[group, np.arange(FILTERS)]
        g["conv"] = np.zeros_like(self.p["conv"])
        g["emb"] = np.zeros_like(self.p["emb"])
        for half in (0, 1):
            at = np.minimum(block + half, len(x) - 1)
            g["conv"][half] = np.einsum("cf,cfk->kf", df, x[at])
            dx = (df[..., None] * self.p["conv"][half].T[None]).reshape(-1, DIM)
            bytes_at = raw.reshape(-1, BLOCK)[at].reshape(-1)
            for d in range(DIM):
                g["emb"][:, d] += np.bincount(bytes_at, dx[:, d], 256)
        return g

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = 14, seed: int = 0) -> None:
        """Adam over shuffled portions of texts; the same rows give the same network."""
        r = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        var = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        total = max(1, epochs * -(-len(y) // 32))
        for _ in range(epochs):
            order = r.permutation(len(y))
            for a in range(0, len(y), 32):
                part = order[a : a + 32]
                t += 1
                rate = 0.01 * (1 - t / (total + 1)) + 1e-4
                for k, v in self.gradients([texts[i] for i in part], y[part]).items():
                    mean[k] += 0.1 * (v - mean[k])
                    var[k] += 0.01 * (v * v - var[k])
                    step = (mean[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.99**t)) + 1e-8)
                    self.p[k] = (self.p[k] - rate * step).astype(np.float32)


def raw_text(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fitted(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The network, or the smoothed share of label 1 where the labels don't show both values.

    Learns from rows outside the held-out quarter whose labels agree, at most
    about SAMPLE_ROWS of each label, chosen by a hash of the id, and of those
    from texts of at most SAMPLE_CHARS characters. The ids of the sample are
    bounded, so they are broadcast; the network is fitted on the driver.
    """
    rows, have = labelled_sample(
        docs, labels, "quality", ~held_out(F.col("_id")), (SAMPLE_ROWS, SAMPLE_ROWS), SAMPLE_CHARS)
    y = np.array([label for _, _, label in rows], float)
    if not 0 < y.sum() < len(y):
        return (have.get(1, 0) + 1) / (sum(have.values()) + 2)
    net = Network()
    net.fit([raw_text(text) for _, text, _ in rows], y)
    net.shift = float(np.log(have[1] / have[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def with_scores(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and `_score`, the probability of label 1, of every row; null and empty texts are scored as empty."""
    net = fitted(docs, labels)
    rows = columns_of(docs, *keep)
    if isinstance(net, float):
        return rows.withColumn("_score", F.lit(net))
    given = rows if "text" in keep else docs.select(*keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[keep].copy()
            out["_score"] = net.scores([raw_text(t) for t in b["text"]])
            yield out

    return given.mapInPandas(score, f"{fields}, _score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1) and predicted (1 from `threshold` on).

    Whole texts are read, however long. A null text counts as an empty one; a
    null id is never held out; repeated rows get the same score. Labels that are
    null, neither 0 nor 1, or contradict each other for an id are not used; with
    fewer than two label values left, every score is the smoothed share of label 1.
    """
    return with_scores(docs, labels, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents scored `threshold` or more, with all their columns; all of them if nothing could be learnt."""
    net = fitted(docs, labels)
    if isinstance(net, float):
        return docs
    judge = F.pandas_udf(lambda texts: pd.Series(net.scores([raw_text(t) for t in texts])), "double")
    return docs.filter(judge(F.col("text")) >= threshold)


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
