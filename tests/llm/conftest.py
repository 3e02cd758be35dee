import pytest
from pyspark.sql import types as T

from oracle import connect

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size string, uid string, " \
         "_id string, key binary, component_id long, pattern string, score double"

LONG = " ".join(f"wort{i % 977} und{i % 31} der{i % 7}" for i in range(40_000))
PROSE = "the quick brown fox jumps over the lazy dog and then it runs far away from the old red barn " \
        "while nobody in the small village has any idea where such a strange animal could have come from today"


@pytest.fixture(scope="session")
def con():
    return connect(SF)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, ties, clashing names."""
    texts = {
        1: None, 2: "", 3: " \t\n ", 4: "one", 5: "One", 6: "one two", 7: LONG, 8: PROSE, 9: PROSE,
        10: PROSE.upper() + "!", 11: "12 34 --", 12: "x▁y \U0001f642 \xa0½", 13: "All rights reserved.",
    }
    rows = [(i, t, "en" if i % 2 else None, [None, "a", "b"][i % 3], 0) for i, t in texts.items()]
    rows += [rows[7], rows[3], (None, PROSE, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, 7, "s", "u", "q", b"k", 3, "p", 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, 0) for i in range(1, 14)] + [(3, 1, 0), (3, 0, 0), (None, 1, None), (5, None, 1), (4, 9, 0)],
        T.StructType.fromDDL("doc_id long, quality int, toxic int"))
