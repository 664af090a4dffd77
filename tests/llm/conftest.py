import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, d long, hs string, h long, spans string, n long, label string, part int, shard int, train boolean, rare string, c0 string, size long, k long, tie long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text), with extra columns whose names clash with those the operators use."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 0.5, 9, 8, "x", 7, "y", 6, "z", 5, 4, True, "r", "c", 3, 2, 1) for i, t in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def nasty():
    """Null and empty texts, blanks only, a very long text, ties, repeated rows, a null doc_id."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, long), (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (8, "é ñ ß <|endoftext|> tail"), (9, "odd space and　wide"), (10, long)]
