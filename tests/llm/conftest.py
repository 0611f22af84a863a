import pytest
from made_texts import prose


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, long and repeated texts, a null id, clashing extra columns."""
    rows = [
        (1, prose(1, 60), "en", "a.example.com", 1),
        (2, None, "en", None, None),
        (3, "", None, "a.example.com", 0),
        (4, " \n\t ", "de", "b.example.org", 4),
        (5, prose(5, 30_000), "en", "a.example.com", 5),
        (6, prose(1, 60), "en", "a.example.com", 1),
        (6, prose(1, 60), "en", "a.example.com", 1),
        (None, prose(9, 40), "en", "a.example.com", 1),
        (8, "x" * 100_000, "fr", "c", 8),
        (9, "Ünïcödé 😀 text   with odd\x1cspace", "de", "b.example.org", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for clash in ("n", "key", "row", "word", "score", "keys", "label", "base", "start", "kept", "id", "draw", "size"):
        df = df.selectExpr("*", f"'clash' as {clash}")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
