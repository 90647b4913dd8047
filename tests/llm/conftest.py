import os

import pytest

SMALL = "/root/testdata/sf0.001"

#: Rows that every operator must stand: nulls, empty and blank texts, repeated rows, a long text.
AWKWARD = [
    (1, "one two three four five six seven eight nine ten", "a"),
    (1, "one two three four five six seven eight nine ten", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \n\t ", "b"),
    (None, "one two three four five six seven eight nine ten", "b"),
    (5, "word " * 40_000, "a"),
    (6, "x" * 50_000, None),
    (7, "Größe 日本語 \u0085 \u2028 <|endoftext|> e\u0301", "c"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward documents, with columns whose names operators use themselves."""
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, source string")
    from pyspark.sql import functions as F

    return df.withColumns({"n_chars": F.length("text").cast("long"), "component_id": F.lit("mine"), "_gone": F.lit(1), "mix_slot": F.lit("mine"), "pcm": F.lit("mine"), "p_toxic": F.lit("mine"), "_id": F.lit(9), "sequence_id": F.lit("mine")})


@pytest.fixture(scope="session")
def small(spark):
    return {f.removesuffix(".parquet"): spark.read.parquet(f"{SMALL}/{f}") for f in os.listdir(SMALL)}


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
