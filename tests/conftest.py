import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from broadsheet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "broadsheet-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over a list of strings."""

    def run(fn, texts):
        from pyspark.sql import functions as F

        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, x string").select("i", fn(F.col("x")).alias("y"))
        return [r["y"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return run


@pytest.fixture
def raw(spark):
    """Landed documents of one source."""

    def build(*bodies, source="s"):
        rows = [(source, f"r{i}", body) for i, body in enumerate(bodies)]
        return spark.createDataFrame(rows, "source_id string, run_id string, body string")

    return build
