import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, size long, kept string"


@pytest.fixture
def documents(spark):
    """A table of documents with extra columns whose names operators also use."""
    def make(rows):
        return spark.createDataFrame([(i, t, la, s, 7, "x") for i, t, la, s in rows], DOCS)

    return make


@pytest.fixture
def odd(documents):
    """Nulls everywhere, empty, blank, long, repeated rows."""
    long = " ".join(f"word{n % 977} and{n}" for n in range(20_000))
    return documents([
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (None, None, None, None), (None, "null id text here", None, "a"),
        (4, long, "en", "a"), (5, "same same same", "en", "b"), (5, "same same same", "en", "b"), (6, "same same same", None, None),
        (7, "one two three four five six seven eight nine ten eleven", "en", "b")])


@pytest.fixture
def nothing(documents):
    return documents([])


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def small():
    return SF
