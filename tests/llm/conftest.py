import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def odd_documents(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en"), (2, None, "en"), (3, "", "fr"), (4, " \n\t ", None),
        (None, "a text without an id stays with the others", "en"), (5, "x" * 200_000, "de"), (6, "word " * 40_000, "de"),
        (7, "12345 !!! ---", None), (1, "the quick brown fox jumps over the lazy dog again and again", "en"),
        (8, "the quick brown fox jumps over the lazy dog again and again", "en"), (9, "naïve Ünïcode \U0001f600 текст", "fr"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = ["uid", "key", "ids", "score", "label", "_uid", "_kept", "hits", "swaps", "component", "n", "bucket"]
    return frame.select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
