import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
SF = "/root/testdata/sf0.001"

ENGLISH = "The old miller walked along the river and counted the boats that came down with the grain of the year"
GERMAN = "Der alte Müller ging am Fluss entlang und zählte die Boote die mit dem Korn des Jahres herunter kamen"
LONG = " ".join(f"{w}{k}" for k in range(12_000) for w in ("river", "grain"))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, ENGLISH, "en", "a", 1), (2, ENGLISH, "en", "a", 1), (2, ENGLISH, "en", "a", 1), (3, ENGLISH + " again", "en", None, 2),
        (4, None, "en", "a", 0), (5, "", None, "b", 0), (None, GERMAN, "de", "b", 3), (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)), (7, GERMAN, None, "b", None), (8, " \t\n\x0b\x0c\r ", "de", "", 7),
        (9, "▁ <|im_end|> \u0000 é 😀\n\nÄÖ", "de", "c", 9), (10, "one", "en", "c", 3), (11, "one two", "en", "c", 7),
        (12, "line one is here\nline one is here\n\nline one is here\n", "en", "c", 40), (13, "12 ½ ² 34", "en", "c", 9),
    ]
    return rows + [(20 + k, f"{ENGLISH} number {k} of many more", "en", "a", 5) for k in range(12)] + [
        (40 + k, f"{GERMAN} Nummer {k} von vielen", "de", "b", 5) for k in range(12)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ("score", "rejected", "kept", "size", "row", "node", "fp", "lang_pred", "doc", "part", "key", "i", "s", "l", "cuts", "times", "kept_id", "rows", "taken", "col")
    return odd.select("*", *(F.lit("x").alias(n) for n in names))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_components(pairs, nodes):
    """Smallest node reachable, by repeated relabelling."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
