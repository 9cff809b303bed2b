import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """documents from (doc_id, text[, lang[, source]]) rows."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Sentences of n invented words from a seed."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(
            "".join(rng.choice(("ka", "lo", "mi", "ter", "sun", "ve")) for _ in range(rng.randint(1, 3)))
            for _ in range(n)
        )

    return make


#: Texts that every operator must survive.
ODD = [
    (900, None),
    (901, ""),
    (902, "   \n\t "),
    (903, "x"),
    (904, "x"),
    (904, "x"),
    (None, "no id"),
    (905, "é ü 日本語 𝄞 \x00   end"),
    (906, "long " * 30_000),
    (907, "0" * 20_000),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
