import pytest

from tests.session import session


@pytest.fixture(scope="session")
def spark():
    return session("4", "4")


@pytest.fixture
def docs(spark):
    """A function that makes a (doc_id, text) table."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make


@pytest.fixture
def sequences(spark):
    """A function that makes a (doc_id, ids) table."""

    def make(*rows):
        return spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")

    return make
