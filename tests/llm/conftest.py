import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu", "xi", "rho"]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + str(chance.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def corner_rows():
    """Nulls in every column, empty and white texts, ties, repeated rows, copies and one long text."""
    base = prose(120, 1)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "s0", 5),
        (2, base, "en", "s0", 5),
        (3, " ".join(near), "en", "s1", 5),
        (4, prose(120, 2), "fr", None, None),
        (4, prose(120, 2), "fr", None, None),
        (5, None, None, None, None),
        (6, "", "en", "s0", 0),
        (7, " \n\t ", None, "s2", 3),
        (8, "Two words", "en", "s0", 9),
        (9, "two WORDS", "en", "s0", 9),
        (None, prose(50, 3), "en", "s0", 1),
        (10, prose(30_000, 4), "de", "s0", 1),
        (11, "é ü 中文字 ß x !! ?", "zh", "s3", 1),
    ]


@pytest.fixture
def corners(spark, corner_rows):
    return spark.createDataFrame(corner_rows, DOCUMENTS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def clashing(corners):
    """Extra columns with the names operators use inside or return."""
    from pyspark.sql import functions as F

    names = ["row", "hit", "ids", "shard", "slot", "size", "words", "level", "stratum", "node", "block", "host"]
    return corners.select("*", *(F.lit("x").alias(n) for n in names))
