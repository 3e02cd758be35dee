import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from corpusloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate Column builders on literal text: one(fn, *texts) -> value."""
    from pyspark.sql import functions as F

    def run(fn, *texts):
        names = [f"c{i}" for i in range(len(texts))]
        df = spark.createDataFrame([texts], ", ".join(f"{n} string" for n in names))
        return df.select(fn(*[F.col(n) for n in names]).alias("r")).first()["r"]

    return run
