import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siftwork import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", "siftwork-tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function over strings: ``column(function, [texts])`` → list of results."""
    from pyspark.sql import functions as F

    def evaluate(function, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, t {kind}").select("i", function(F.col("t")).alias("r"))
        return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return evaluate
