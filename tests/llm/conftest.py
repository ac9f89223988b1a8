import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside
CLASHING = ("row", "fp", "ids", "words", "_text", "stratum", "spans", "part", "n", "first", "_row", "uid", "shard")


@pytest.fixture(scope="session")
def prose():
    def make(words, seed, vocabulary=400):
        rng = random.Random(seed)
        return " ".join("w" + "".join(rng.choice("aeioutnsr") for _ in range(3)) + str(rng.randrange(vocabulary)) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = prose(30_000, 5)
    rows = [
        (1, prose(60, 1), "en", "a", 1),
        (2, prose(60, 1), "de", "a", 2),
        (2, prose(60, 1), "de", "a", 2),
        (3, None, None, None, None),
        (4, "", "xx", "b", 0),
        (None, prose(40, 2), "en", "a", 3),
        (None, prose(40, 2), "en", None, 3),
        (5, " \t\n ", "en", "b", 4),
        (6, long, "en", "a", 5),
        (7, "Zwei Wörter", "de", "c", 11),
        (8, "eins zwei drei", "de", "c", 14),
        (9, "ein  geschütztes\u0085Wort <|endoftext|>, und Á", "de", "c", 30),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, COLUMNS)
    return docs.selectExpr("*", *(f"'x' as `{c}`" for c in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
