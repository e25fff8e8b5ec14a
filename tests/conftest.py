import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinara.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over a list of texts."""

    def run(values, build, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        from pyspark.sql import functions as F

        out = rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in out]

    return run
