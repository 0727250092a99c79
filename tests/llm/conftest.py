import pytest

ODD = [
    (1, None, None, None, 7),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", None, 5),
    (4, "The same words again and again, the same words.", "en", "a", 47),
    (4, "The same words again and again, the same words.", "en", "a", 47),
    (5, "The same words again and again, the same words.", "en", "b", 47),
    (6, "word " * 30_000, "en", "a", 150_000),
    (7, "x" * 20_000, None, "a", 20_000),
    (8, "Ünïcödé 日本語 😀 ſ K", "de", "a", 18),
    (None, "A row without an id.", "en", "a", 20),
    (9, "One\ntwo  three.\r\nFour", "en", "a", 21),
]
#: Extra columns with names that operators use themselves.
CLASHES = ["text_", "words", "spans", "items", "id", "fp", "component_id", "score", "votes", "weight", "probability", "u", "key", "range", "row", "base", "value", "block", "n_tokens", "topic", "keep"]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
