"""All queries of this subpackage and their SQL, for the entry module."""

from corpusloom.llm import (  # noqa: F401
    codes,
    fingerprint,
    jaccard,
    language,
    licenses,
    mixing,
    neighbours,
    pieces,
    quality,
    ranking,
    substring,
    toxicity,
    urls,
)
from corpusloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
