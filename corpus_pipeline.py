"""Corpus pipeline: each stage works on all documents that the one before kept.

1. The quality classifier drops the documents it rejects.
2. The n-gram Jaccard join (five words, 80 %) leaves one document of each group.
3. Substring dedup takes out words of runs of 50 that also start elsewhere.
4. Mixing repeats, keeps and leaves out documents so that sources meet their targets.
5. SentencePiece encoding with seeded merge-dropout, and the proof that it decodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import jaccard, mixing, pieces, quality, substring
from corpusloom.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, words=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs, window=50)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, weights=[3, 1, 2])


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", pieces_stage),
]
# A trained network and seeded choices are not SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
