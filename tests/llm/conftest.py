import os

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    if not os.path.exists(SF):
        pytest.skip("test data not present")
    return SF


@pytest.fixture()
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture()
def edge_rows():
    """Nulls in every column, empty and blank texts, a long one, ties, repeated rows, repeated ids."""
    long_text = " ".join(f"w{i % 7000}" for i in range(30_000))
    base = " ".join(f"word{i}" for i in range(80))
    near = base.replace("word40", "other")
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "de", "b", 2),
            (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \n\t ", "en", None, 3), (7, "one two", "fr", "a", 7),
            (8, "ONE  two", "fr", "c", 7), (9, long_text, "en", "c", 9), (None, "no id here at all", "en", "a", 1),
            (None, None, None, None, None), (10, "line one\nline one\nline two", "en", "é", 4), (11, base, "en", None, 1),
            (12, "x" * 5000, "en", "b", 5), (13, "grüße aus köln über straße", "de", "b", 5)]
    return rows


@pytest.fixture()
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns whose names the operators use themselves."""
    extra = "score double, kept boolean, size long, shard int, rank long, row string, of string, m_kept int, start long"
    return spark.createDataFrame([(*r, 0.5, True, 1, 1, 1, "r", "o", 1, 2) for r in edge_rows], f"{DOCS}, {extra}")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
