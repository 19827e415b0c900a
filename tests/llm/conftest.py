import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from pairloom.session import ship_package

    ship_package(spark)


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing column names."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [
        (1, "a b c d e f", "en", "s1", 3, "x", 1), (2, None, "en", "s1", None, "x", 1), (3, "", None, None, 0, "x", 1),
        (4, " \t\n", "en", None, 3, "x", 1), (5, "a b c d e f", "en", "s2", 3, "x", 1), (6, long, "en", "s2", 3, None, None),
        (7, long + " end", "en", "s1", 3, "x", 1), (8, "A b\tc d e  F", "en", "s3", 3, "x", 1), (9, "é ê 漢字", "fr", "s3", 3, "x", 1),
        (10, "one two", "en", "é", 3, "x", 1), (11, "one two", "en", "z", 3, "x", 1),
    ]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, _row string, key long"
    return spark.createDataFrame(rows, ddl)
