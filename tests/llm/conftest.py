import os

import duckdb
import pytest

SF = os.environ.get("CORPUSLOOM_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs():
    """doc_id, text, source of the smallest tables."""
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()


WEIRD = [
    (1, None, None, None, 0), (2, "", "en", "a", 0), (3, "one", "en", "a", 3), (3, "one", "en", "a", 3), (None, "two words", "en", None, 9),
    (None, None, None, "b", 0), (4, " \t\n ", "en", "b", 4), (5, "w " * 60_000, "en", "b", 120_000), (6, "x" * 100_000, "en", "c", 100_000),
    (7, "one", "de", "a", 3), (8, "ünï\u00a0cödé — ÀÉ\n\n\nA B", "fr", "Z", 20),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def weird(spark):
    """Nulls, empty and very long texts, repeated rows, repeated and missing ids."""
    return spark.createDataFrame(WEIRD, SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
