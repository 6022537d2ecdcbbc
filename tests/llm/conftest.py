import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls, empty and very long texts, repeats, and columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "x", 1),
        (2, None, None, None),
        (3, "", "x", 1),
        (4, "   \n\t ", "x", 1),
        (5, "The quick brown fox jumps over the lazy dog.", "x", 1),
        (5, "The quick brown fox jumps over the lazy dog.", "x", 1),
        (6, "word " * 30_000, "x", 1),
        (7, "naïve café – 日本語 <|endoftext|> don't 12345  ֋೜ end", None, 2),
        (8, "a", "y", 3),
        (None, "A null id keeps its row.", "y", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, n_bytes int")
