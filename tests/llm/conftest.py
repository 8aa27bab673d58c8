import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a table of documents from `(doc_id, text)` or `(doc_id, text, source)` rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns with the names the operators use."""
    long = " ".join(f"word{i % 977} tail{i}" for i in range(12_000))
    rows = [
        (1, None, None), (2, "", "a"), (3, "  \n\t ", "b"), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"), (None, "some text without an id", None),
        (None, None, None), (6, long, "c"), (7, "naïve café 梦 \U0001f600 ▁ tail ", "b"), (8, "x" * 3_000, "b"),
    ]
    df = documents(rows)
    clashing = ("key", "row", "size", "id", "label", "score", "token", "part", "target", "copies", "n", "a", "b", "ids")
    return df.selectExpr("*", *[f"'odd' as `{c}`" for c in clashing])


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)
