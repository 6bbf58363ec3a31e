import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _fp string, ids string, window string"


@pytest.fixture(scope="session")
def table_of(spark):
    """A documents table (with columns whose names clash with inner ones) from (id, text) rows."""

    def make(rows):
        full = [(d, t, None if i % 5 == 4 else "en", None if i % 4 == 3 else f"s{i % 3}", i, "x", "y", "z") for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    import random

    rng = random.Random(3)
    words = ["alpha", "be", "gamma,", "é", "Straße", "delta.", "日本", "zeta!", "12", "x", "theta", "iota's"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(n))

    passage = prose(60)
    long = "\n".join(prose(400) for _ in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (None, "no id"), (None, None)]
    rows += [(10 + i, prose(80) + " " + passage + "\n" + prose(70)) for i in range(12)]
    rows += [(40, long), (41, long), (41, long), (42, long.replace("alpha", "omega", 3))]
    rows += [(43, "<|endoftext|> a  b\n\n c <|endoftext|>"), (44, "ab" * 3000), (45, "  x   y "), (46, "ΑΣ ﬁ ½ ́a 😀\x1c|")]
    return rows
