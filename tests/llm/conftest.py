import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"word{i % 977} other{i % 13}." for i in range(30_000))
    rows = [
        (1, None, None, None, None, "x"),
        (2, "", "en", "s", 0, "x"),
        (3, "one two three four five six seven eight nine ten.", "en", "s", 9, None),
        (3, "one two three four five six seven eight nine ten.", "en", "s", 9, None),
        (4, "one two three four five six seven eight nine ten.", "de", "t", 9, None),
        (None, "one two three four five six seven eight nine ten.", None, None, None, None),
        (None, None, None, None, None, None),
        (5, long, "en", "s", len(long), "y"),
        (6, long + " tail", "en", "s", len(long) + 5, "y"),
        (7, "12 34 !!", None, "s", 8, "y"),
        (8, "é中文 \U0001f600\u0000 ퟿", "fr", "s", 8, "y"),
    ]
    return spark.createDataFrame(rows, DOCS + ", kept string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
