import random

import pytest


def words(seed, n, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(1, 7))) for _ in range(n))


#: Nulls in every column, empty and very long texts, ties, repeated rows.
ODD_ROWS = [
    (1, words(1, 120), 7, "x", None),
    (2, words(1, 120), 7, "y", 1.0),  # copy of 1
    (2, words(1, 120), 7, "y", 1.0),  # repeated row
    (3, None, None, None, None),
    (4, "", 0, "", 0.0),
    (5, " \n\t ", 0, "", 0.0),
    (None, "no id here, some words follow", 0, "z", 0.0),
    (None, None, 0, "z", 0.0),
    (6, words(6, 30_000), 3, "long", 2.0),
    (7, "x" * 50_000, 3, "one word", 2.0),
    (8, 'é ñ 😀 "quoted" ▁ ' + words(8, 60), 3, "u", 2.0),
    (9, words(1, 119) + " other", 3, "near 1", 2.0),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame(ODD_ROWS, "doc_id long, text string, id long, txt string, h double").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return dict(documents.select("doc_id", "text").collect())
