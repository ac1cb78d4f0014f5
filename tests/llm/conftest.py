import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, id long, size string, rank int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names clash with those of the operators."""

    def make(rows):
        full = [(i, t, lang, src, len(t) if t is not None else None, "x", 1, "y", 2) for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(150_000))
    return make_docs(
        [
            (None, "no id at all here", "en", "a"), (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "de", "b"), (4, long, "en", "a"), (4, long, "en", "a"),
            (5, "one", "en", ""), (6, "one", "en", "b"), (7, "É É été x  \x0b y", "fr", None), (8, "a b c d e f g h i j k l", "en", "a"), (9, "a b c d e f g h i j k l", "en", "b"),
        ]
    )
