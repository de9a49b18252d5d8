"""Tables with every odd case, as fixtures for the tests of this folder."""

import pytest


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and clashing names."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 33, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "a", 0, "x"),
        (4, "  \n\t ", "en", "a", 5, "x"),
        (5, "One two THREE four five six seven", "en", "a", 33, "x"),
        (5, "One two THREE four five six seven", "en", "a", 33, "x"),
        (None, "one two three four five six seven", "en", "a", 33, "x"),
        (6, long_text, "en", None, len(long_text), "x"),
        (7, "short", "de", "a", 5, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
