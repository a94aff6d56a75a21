import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, norm string, salt int, size int, kept boolean"


def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 997} the. and of" for i in range(6000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
        (2, "alpha beta\tgamma delta epsilon zeta eta theta iota  kappa", "en", "a"),
        (2, "alpha beta\tgamma delta epsilon zeta eta theta iota  kappa", "en", "a"),
        (3, None, None, None),
        (4, "", "de", None),
        (5, " \n\t ", None, "b"),
        (6, long_text, "en", "c"),
        (7, long_text + " tail", "en", "c"),
        (8, "x", "fr", "b"),
        (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
        (9, "café über naïve <|x|> [INST] </s>\x00 \x1c  é", "fr", None),
    ]
    return [(*r, 0, "n", 1, 2, True) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
