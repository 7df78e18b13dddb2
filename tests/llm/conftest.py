import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark, sf):
    return spark.read.parquet(f"{sf}/benchmark.parquet")


@pytest.fixture(scope="session")
def make(spark):
    def docs(*rows):
        """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
        return spark.createDataFrame([(*r, *("en", "s")[len(r) - 2 :], 0) for r in rows], DOCS)

    return docs


@pytest.fixture(scope="session")
def odd(make):
    """NULLs in every column, empty and blank texts, repeated rows, and one very long text."""
    long_text = " ".join(f"w{i % 997}" for i in range(60_000))
    return make(
        (None, None, None, None), (None, "some text", None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"),
        (5, "a b c d e f"), (5, "another text of the same id"), (6, long_text, "en", None), (7, "€ 中文 <|x|> 😀\x00 é", None, "t"),
    )


@pytest.fixture(scope="session")
def empty(make, documents):
    return documents.limit(0)

