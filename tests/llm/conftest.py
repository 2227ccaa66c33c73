"""Shared rows of the operator tests: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import pytest
from pyspark.sql import functions as F

LONG = "wort und satz " * 4000
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon".split()
PROSE = " ".join(WORDS[(7 * i) % 20] + str(i % 13) for i in range(120))
ROWS = [
    (1, PROSE), (2, PROSE), (3, PROSE + " omega"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (7, LONG), (8, "one two"), (9, "one two"),
    (None, "no id here at all"), (10, "Zeile eins\nZeile eins\nZeile zwei ### *** $$$ |||"), (11, "日本語 テキスト é́ <|endoftext|> x"), (12, PROSE.upper()),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ROWS as documents, with columns whose names the operators use themselves."""
    return spark.createDataFrame(ROWS, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"),
        F.lit("x").alias("fp"), F.lit("y").alias("kept"), F.lit(0).alias("rate"), F.lit("z").alias("host"), F.lit(1).alias("n"), F.lit(2).alias("v"))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, 1, None), (8, 0, 0), (10, 0, 1), (12, 0, 0), (7, 1, 0), (7, 0, 0), (11, 1, 0), (None, 1, 0), (5, None, None), (9, 0, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
