"""Tables of odd rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, stems: str = "the of ing and re er on st") -> str:
    draw = random.Random(seed)
    parts = stems.split()
    text = " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words))
    return text.capitalize() + "."


@pytest.fixture(scope="session")
def odd_docs(spark):
    long_text = prose(1, 30_000)
    same = prose(2, 40)
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \t\n ", "en", None, 3),
        (4, "one two", "en", "a", 7),
        (5, "ONE  two", "en", "a", 8),
        (6, long_text, "en", "a", len(long_text)),
        (7, same, "en", "b", len(same)),
        (8, same, "en", "b", len(same)),
        (8, same, "en", "b", len(same)),
        (9, prose(3, 60), "de", "b", 1),
        (9, prose(4, 60), "de", "b", 1),
        (None, prose(5, 50), "fr", "c", 1),
        (10, "123 456 !!! ???", "fr", "c", 15),
        (11, "é ñ ß     漢字 😀 a\u0000b", "fr", "c", 20),
        (12, prose(6, 50) + "\n" + prose(7, 30), "en", "d", 1),
        (13, prose(8, 30) + "\n" + prose(7, 30), "en", "d", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """The same rows with columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    clash = ["row", "bucket", "digest", "node", "component", "spans", "version", "score", "w", "wh", "label", "x", "block", "shard", "piece", "term"]
    return odd_docs.select("*", *[F.lit("own").alias(c) for c in clash])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
