import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, h string, findings string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = "the quick brown fox jumps over the lazy dog " * 4000 + "x" * 20_000
    near = " ".join(f"word{i}" for i in range(200))
    rows = [
        (1, None, None, None, None, 7, "a", None),
        (2, "", "en", "s", 0, None, None, "f"),
        (3, "one", "en", "s", 3, 1, "b", None),
        (4, " \t\n ", None, "s", 4, 1, "b", None),
        (5, "12345 !?", "en", "s", 8, 1, "b", None),
        (6, long, "en", "s", len(long), 1, "b", None),
        (7, long, "en", "s", len(long), 1, "b", None),
        (8, near, "en", "s", 1, 1, "b", None),
        (9, near + " changed", "en", None, 1, 1, "b", None),
        (9, near + " changed", "en", None, 1, 1, "b", None),
        (10, near.upper(), "fr", "s", 1, 1, "b", None),
        (11, "Éte ça 日本語 🙂 été", "fr", "s", 1, 1, "b", None),
        (11, "another text with the same id", "en", "s", 1, 1, "b", None),
        (None, near, "en", "s", 1, 1, "b", None),
        (12, 'password = "hunter22222" x', "en", "s", 1, 1, "b", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
