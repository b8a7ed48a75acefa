import pytest
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    long = "Lorem ipsum dolor 12 sit amet. " * 40_000
    rows = [
        (1, "one two three four five six", "en", "s", 1), (1, "one two three four five six", "en", "s", 1), (2, None, "en", None, None),
        (3, "", None, "s", 0), (4, " \t\n", "fr", "s", 3), (5, long, "en", "s", len(long)), (6, long, "en", "s", len(long)),
        (None, "one two three four five six", None, None, None), (7, "É🙂 ünï +1 (974) 555-3436 a.b@c.de 1.2.3.4", "de", "s", 9),
        (1, "another text under the same id", "en", "s", 1), (8, "1234567890" * 2000, "xx", "s", 1),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (8, 0, 1)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use inside."""

    def add(df):
        for name in ("id", "v", "token", "label", "score", "n", "key", "count", "a", "b", "item", "component"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return add
