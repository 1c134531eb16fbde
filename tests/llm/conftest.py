import pytest

AWKWARD = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, "
           "bands string, leaks string, _block string, prompt string")


@pytest.fixture
def awkward(spark):
    """Nulls everywhere, an empty and a very long text, repeated rows, columns with clashing names."""
    def row(i, text, lang="en"):
        return (i, text, lang, "s", 1, 1.0, "k", "b", "l", "x", "p")

    long = " ".join(f"word{i % 977}" for i in range(30_000))
    words = " ".join(f"term{i}" for i in range(60))
    rows = [row(1, words), row(1, words), row(2, words), row(3, None), row(4, ""), row(None, words), row(None, None),
            row(5, long, None), row(6, "  \n\t "), row(7, "a"), (None,) * 11]
    return spark.createDataFrame(rows, AWKWARD)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], AWKWARD)
