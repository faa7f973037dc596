import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

LONG = "estion thonre andhe " * 20_000


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that operators must not trip over, with columns named like their results."""
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \n\t ", "en", None),
        (4, "12345 ... !!! \U0001f600", "en", "a"),
        (5, "the of and the there is a house in the street", "en", "a"),
        (5, "the of and the there is a house in the street", "en", "a"),
        (6, "the of and the there is a house in the street", "en", "b"),
        (None, "the of and to be or not to be", None, None),
        (7, LONG, "en", "b"),
        (8, "der die das und nicht ein eine Straße", "de", "b"),
        (9, "Привет мир и люди", None, "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = "lang_pred lang_spans leaks pii toxicity token_counts n_words part row key n_chars words"
    return df.withColumns({name: F.lit(7).cast("long") for name in names.split()})


@pytest.fixture(scope="session")
def no_rows(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet(f"{SMALL}/documents.parquet")
