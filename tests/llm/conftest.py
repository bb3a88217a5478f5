import pytest

#: Null and empty texts, a very long one, repeated rows, a null identifier, and columns whose names operators use inside.
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, row string, ka long, fp long, tokens string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(1, None), (2, ""), (3, LONG), (4, "one two three four five six"), (4, "one two three four five six"), (5, "one two three four five six"), (None, "lonely words here and there"), (6, " \n\t "), (7, "Ünï çødé 🙂 日本語")]
    return spark.createDataFrame([(i, t, None if i == 5 else "en", "r", 1, 2, "t", 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 0), (3, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
