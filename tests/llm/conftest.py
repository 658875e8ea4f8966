import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, a clashing extra column."""
    rows = [
        (1, "The and of to that is here, idiot of a clown.", "en", "a", 10, "x"),
        (1, "The and of to that is here, idiot of a clown.", "en", "a", 10, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "b", 0, "y"),
        (None, "A text without a number but with words", None, "b", 3, None),
        (4, " \t\n", "en", None, 3, "z"),
        (5, "Licensed under the Apache License, Version 2.0. " + "word " * 60000, "en", "a", 1, "z"),
        (6, 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"', "en", "c", 1, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
