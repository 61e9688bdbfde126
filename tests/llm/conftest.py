import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, size string, word string, key int, rank int"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    prose = "the cat sat on the mat and looked at the dog over there.\nsecond line with some more words in it\n"
    rows = [
        (1, prose, "en", "a", 1, 1, "s", "w", 1, 1),
        (1, prose, "en", "a", 1, 1, "s", "w", 1, 1),
        (2, prose + "tail", "en", None, 1, None, None, None, None, None),
        (None, prose, None, "a", None, 1, "s", "w", 1, 1),
        (3, None, "en", "b", 1, 1, "s", "w", 1, 1),
        (4, "", "de", "b", 1, 1, "s", "w", 1, 1),
        (5, long_text, "de", "b", 1, 1, "s", "w", 1, 1),
        (6, "  \t\n ", "de", "c", 1, 1, "s", "w", 1, 1),
        (7, "12 34 !?", None, "c", 1, 1, "s", "w", 1, 1),
        (8, "Ärger über 漢字 🙂 <|endoftext|> x", "de", "c", 1, 1, "s", "w", 1, 1),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
