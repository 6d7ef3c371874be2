import pytest

#: Names that operators use inside, or return.
CLASHING = "key size n a b h shard offset component rep digest keep_id spans bucket score toxic item_id edits repeats cell".split()
LONG = "many words in one very long text. " * 9000


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    return [
        (1, "one two three four five six", "en", "s"),
        (1, "one two three four five six", "en", "s"),
        (2, None, None, None),
        (3, "", "en", "s"),
        (4, "   \n\t ", "en", None),
        (5, LONG, "fr", "t"),
        (6, LONG, "fr", "t"),
        (None, "no id at all here", "de", "s"),
        (None, None, None, None),
        (7, "ONE two three\tfour five six", None, "t"),
        (8, "word", "en", "é"),
        (9, "naïve \U0001f600 Ünïcode ▁ text <|endoftext|> </s>", "en", "é"),
    ]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in CLASHING:
        df = df.selectExpr("*", f"'other' AS {name}")
    return df


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
