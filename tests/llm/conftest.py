import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """``docs([texts])``: a table of documents with ids from 0, and columns that operators might clash with."""

    def make(texts):
        rows = [(i, t, "a", "b") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, score string, words string")

    return make


@pytest.fixture(scope="session")
def sf():
    import os

    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF
