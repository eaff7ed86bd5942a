import pytest
from pyspark.sql import functions as F

ROWS = [(1, None), (2, ""), (3, "one two"), (4, "word " * 400 + "end"), (4, "word " * 400 + "end"), (None, "no id here at all, only a text"),
        (5, "Line one is here for a test of repeats\nLine two is here for a test of repeats\ntail five"),
        (6, "Line one is here for a test of repeats\nLine two is here for a test of repeats\ntail six"), (7, "  \n\t \n"),
        (8, "ünïcödé ñandú \U0001f600 x"), (9, "a" * 700)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long, repeated rows, and extra columns whose names clash with internal ones."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("line_row"),
                     F.lit(2).alias("decontamination"), F.lit(3).alias("tox_x"), F.lit(4).alias("score"), F.lit(5).alias("pii_row"),
                     F.lit(6).alias("s"), F.lit(7).alias("turn"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
