"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

DOC_SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def prose(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of awkward documents."""
    shared, long = prose("shared", 70), prose("long", 3000, 5000)
    a = prose("a", 200)
    rows = [
        (1, a),
        (2, a),
        (2, a),  # a repeated row
        (3, prose("b", 30) + " " + shared + "\n" + prose("c", 25)),
        (4, prose("d", 10) + "\t " + shared),
        (4, shared + " " + prose("e", 60)),  # a repeated id with another text
        (5, None),
        (6, ""),
        (7, " \t\n \x0b\x0c\r"),
        (8, "One"),
        (9, "Is onhe. " * 120),
        (10, long),
        (11, long + " " + a),
        (12, "Ünï cödé 漢字 \U0001f600 é   <|endoftext|> it's 12,5%" * 5),
        (13, " ".join(prose("edit", 200).split()[:150]) + " x y z"),
        (14, prose("edit", 200)),
        (None, a),
        (None, None),
        (-5, prose("f", 80)),
        (15, "the the the " + "x" * 3000),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with columns whose names operators use too."""
    rows = [(i, t, (None, "en", "fr")[k % 3], "s", len(t or "")) for k, (i, t) in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in ("fingerprint", "prefix", "words", "n_words", "blob", "kept", "version", "mask", "h", "item_id"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame.repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
