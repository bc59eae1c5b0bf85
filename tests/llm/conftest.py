import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, metrics long, v long, node string, word string"
LONG = "alpha beta gamma delta " * 20_000


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, and columns with the names operators use inside."""
    body = "one two three four five six seven eight nine ten eleven twelve"
    return [
        (1, body, "en", "a", 3, "r", 1, 2, "n", "w"), (1, body, "en", "a", 3, "r", 1, 2, "n", "w"), (1, "other words", None, None, None, None, None, None, None, None),
        (None, body, "en", "a", 3, "r", 1, 2, "n", "w"), (None, None, None, None, None, None, None, None, None, None),
        (2, "", "en", "a", 0, "r", 1, 2, "n", "w"), (3, None, "de", "b", None, "r", 1, 2, "n", "w"), (4, LONG, "en", "a", 1, "r", 1, 2, "n", "w"),
        (5, "x" * 200_000, "en", "a", 1, "r", 1, 2, "n", "w"), (6, "  \n\t \x0b", "en", "a", 1, "r", 1, 2, "n", "w"), (7, "one", "", "", 1, "", 1, 2, "", ""),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def texts(spark):
    def make(*found):
        return spark.createDataFrame([(i, t) for i, t in enumerate(found)], "doc_id long, text string")

    return make
