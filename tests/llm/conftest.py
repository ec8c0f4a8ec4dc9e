from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers can import the package."""
    from storelift.llm.common import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    long_text = " ".join(f"word{i % 977} is{i % 13}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nA line that is shared here.", "en", "a", 5),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.\nA line that is shared here.", "en", "a", 5),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.\nA line that is shared here.", "en", "a", 5),
        (3, None, None, None, None), (4, "", "fr", "b", 0), (5, " \t\n ", "fr", "b", 3), (6, "one two", "de", "b", 7),
        (7, "One TWO", None, "b", 7), (8, long_text, "en", "c", len(long_text)), (None, "no id at all in this row", "en", "c", 1),
        (9, "It's a l'été “quoted” naïve — 日本語 text\r\n\twith <|endoftext|> marks  and   spaces ", "fr", None, 9),
        (10, "12345 678 !!! ???", "en", "a", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
