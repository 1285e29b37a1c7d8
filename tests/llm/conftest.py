"""Small tables for the training-data operators."""

from __future__ import annotations

import pytest

# Null in every column, empty and blank texts, ties, repeated rows, a long text, other scripts.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
    (2, "the QUICK brown fox jumps over the lazy dog", "en", "a", 43),
    (3, "The quick brown fox jumps over the lazy cat", "en", "b", 43),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n ", "de", None, 4),
    (7, "été É straße 東京  タワー x y  ", "fr", "c", 20),
    (8, " ".join(f"word{i % 997}" for i in range(9000)), "en", "a", 60000),
    (8, " ".join(f"word{i % 997}" for i in range(9000)), "en", "a", 60000),
    (9, "one", "en", "c", 3),
    (10, "ONE", "en", "c", 3),
    (11, "<|endoftext|> <s> it's 12,5 €", "en", "b", 25),
    (None, "nobody knows the id of this text at all", "en", "a", 39),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """The rows, spread over several files."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(ROWS, SCHEMA).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
