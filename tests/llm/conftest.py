import duckdb
import pytest

from tidemark.llm.runtime import prepare

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm_spark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the smallest table, by id."""
    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def pages():
    return duckdb.sql(f"select page_id, url, html from '{SMALL}/pages.parquet' order by page_id").fetchall()


# Nulls in every column, empty and odd texts, ties, repeated rows, a long text.
AWKWARD = [
    (1, None, None, None, None),
    (None, "one two three four five six", "en", "s", 1),
    (2, "", "en", "s", 0),
    (3, " \t\n\x0b\f\r ", None, "s", 3),
    (4, "Same words here again and again", "en", "s", 5),
    (4, "Same words here again and again", "en", "s", 5),
    (5, "Same words here again and again", "de", None, 5),
    (6, "é日本語 \U0001f600 %%% <|endoftext|> it's 123", "fr", "s", 9),
    (7, "lorem ipsum dolor " * 3_000, "en", "s", 9),
    (8, "".join(chr(33 + (i * 7919) % 90) for i in range(40_000)), "xx", "s", 9),
    (9, "a" * 20_000, "en", "s", 9),
]


@pytest.fixture(scope="session")
def awkward(llm_spark):
    """Documents with further columns whose names the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = llm_spark.createDataFrame(AWKWARD, schema)
    return df.selectExpr("*", "'x' as key", "1 as print", "2 as mask", "'y' as kept", "3L as k1", "4 as row", "'z' as id", "0 as gram")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
