import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, hash long, features string, kept string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents from (doc_id, text[, lang]) with other columns whose names operators use inside, most of them null."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or ""), None, 7, "x", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, short, very long, repeated and null-id rows."""
    rng = random.Random(1)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(400)) for _ in range(9000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "one two"), (6, long), (7, long + " end"), (8, "A b\x0bC d e f"), (8, "A b\x0bC d e f"), (None, long), (9, "Été naïve — 日本語 text with ▁ mark")]
