"""Difficult rows as fixtures; test modules import them by name."""

import pytest

#: Rows that every operator must take: nulls, empty and blank texts, repeated
#: rows, a very long text, columns whose names could clash.
LONG = " ".join(f"w{i % 997}" for i in range(120_000))


@pytest.fixture()
def odd_docs(spark):
    """documents with difficult rows and clashing extra columns."""
    rows = [
        (1, "Plain words. " * 12, "en", "a", 156, "x", 1),
        (1, "Plain words. " * 12, "en", "a", 156, "x", 1),
        (2, None, "en", "a", None, "x", 2),
        (3, "", None, None, 0, None, None),
        (4, " \t\r\n\x0b\x0c", "fr", "b", 6, "y", 3),
        (None, "No id here, and yet a text.", "en", None, 27, "y", 4),
        (5, LONG, "en", "a", len(LONG), "y", 5),
        (6, "Ünïcode ß Σ\x1c\x85\xa0 <|endoftext|> 日本 😀", None, "b", 30, "z", 6),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, label string, n_words long"
    )


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.where("false")
