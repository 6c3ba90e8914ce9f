import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: nulls in every column, empty and blank texts, ties, repeated rows
AWKWARD = [(1, "One two three four five six seven.\nshared line of text\nend"), (2, "other words here\nSHARED line of text  \nx"), (3, None), (4, ""), (None, "lone words without a key here"), (None, None), (5, " \t\n "), (2, "other words here\nSHARED line of text  \nx"), (6, "1234 --- !!"), (7, "é" * 30), (8, "long " * 20000)]


@pytest.fixture
def awkward(documents):
    return documents(AWKWARD)
