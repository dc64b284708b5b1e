import pytest

from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    line = "This Line is Repeated in several documents."
    long_word, base = "x" * 120_000, prose(200, 1)
    return [
        (1, base, "en", "a", 7),
        (2, base, "en", "a", 7),
        (3, base + " tail", "en", None, None),
        (4, None, "en", "b", 1),
        (5, "", None, "b", 0),
        (6, " \t\n ", "de", "b", 4),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (7, long_word, "en", "c", 1),
        (8, prose(30_000, 2), "en", "c", 1),
        (9, line + "\n" + prose(40, 3) + "\n" + line.upper() + " ", "en", "a", 1),
        (10, prose(40, 4) + "\n  " + line, "en", "a", 1),
        (11, line, "en", "d", 1),
        (11, line, "en", "d", 1),
        (12, "one two", "fr", "d", 1),
        (12, prose(60, 5), "fr", "d", 1),
        (13, "12345 !!! ???", "en", "d", 1),
        (14, "z" * 99 + "é" * 200, "en", "d", 1),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


#: names that the operators use for their results or on the way
CLASHES = "kept score size rank position target taken key n_words n_lines held_out n_bytes n_entities lang_pred component_id ids start end count".split()


@pytest.fixture(scope="session")
def clashing(edges):
    from pyspark.sql import functions as F

    return edges.withColumns({c: F.lit("clash") for c in CLASHES})
