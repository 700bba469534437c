import pytest

from tillstream.llm.queries import ship

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def text_spark(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(text_spark):
    return text_spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows(text_spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with names the operators use."""
    rows = [
        (None, None, 1, "a"), (3, "", 2, "b"), (3, "  \n a", 3, "c"), (3, "  \n a", 3, "c"),
        (1, "x y z a b c d e f " * 3000, 4, "d"), (2, None, 5, None), (4, "w" * 30_000, 6, "f"),
        (5, "123 !!", 7, "g"),
    ]
    return text_spark.createDataFrame(rows, "doc_id long, text string, score int, IDS string")
