"""Small tables of documents for the tests of the llm operators."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Every odd case: null and empty texts, blanks, a very long text, ties, repeated rows, null keys.
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, "日本語 текст ελληνικά 🙂"),
    (6, "a b c d e f g h"), (6, "a b c d e f g h"), (7, "a b c d e f g h"),
    (8, "word " * 30_000), (None, "a b c d e f g h"), (None, None), (9, "it's   <|endoftext|> x'll"),
    (10, "1234 5678 !!! ???"), (11, "x" * 5000), (12, "\n\n\n"), (13, "9" * 40),
]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        filled = [(k, t, "en", "s", len(t or "")) for k, t in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Odd rows with columns whose names clash with those of results."""
    from pyspark.sql import functions as F

    docs = documents(ODD)
    for name in ("n", "kept", "score", "node", "component", "mark", "word", "token", "row", "class"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
