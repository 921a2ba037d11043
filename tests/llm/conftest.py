import pytest

LONG = " ".join(f"word{i % 977} thing{i % 31}." for i in range(30_000))
EDGES = [
    (1, "A plain text of some words, which is long enough.", "en", "a"),
    (1, "A plain text of some words, which is long enough.", "en", "a"),
    (2, "A plain text of some words, which is long enough.", "en", None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \n\t ", "fr", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " tail", None, None),
    (None, "No id here.", "de", "b"),
    (None, None, None, None),
    (-9, "日本語のテキスト 🎉 é x́", "ja", "c"),
    (8, "x" * 5000, "en", "a"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and long texts, repeated rows, and clashing extra columns."""
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    for name in ("n", "h", "rep", "batch", "score", "part", "start", "label", "_group", "n_chars", "spans", "components"):
        docs = docs.selectExpr("*", f"7L AS `{name}`")
    return docs


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)
