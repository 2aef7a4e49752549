"""Rare languages, and texts that repeat one pattern a million times."""

import pytest
from ledgerline.llm import language_id, surrogates
from pyspark.sql import functions as F


def test_a_language_within_the_calibration_slice_is_learned(spark):
    """Copies of one text fall to one side of the split; whichever it is, their language is learned."""
    rows = [(i, f"the {i} quick brown foxes jump over {i} lazy dogs and rest", "en") for i in range(30)]
    for n, text in enumerate(("zzyx qwrt plmk", "ååå øøø æææ", "ñandú güero", "жук еж уж", "abba acca adda")):
        docs = spark.createDataFrame(rows + [(100 + i, text, "xx") for i in range(3)], "doc_id long, text string, lang string")
        assert sorted(language_id.fit(docs, F.lit(True)).names) == ["en", "xx"], n


@pytest.mark.parametrize("piece", ["a.", "x@", "7", "a", "Mr A", "+1 ", "1.", "x@a.", "token=", "-", "(1"])
def test_personal_data_in_texts_of_one_pattern(spark, piece):
    """No pattern needs a stack that grows with the text."""
    text = "x@" + piece * (200_000 // len(piece)) if piece == "a." else piece * (200_000 // len(piece))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = docs.select(F.size(surrogates.entities(F.col("text"))).alias("n")).first()["n"]
    assert found >= 0
