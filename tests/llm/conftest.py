import pytest

LONG = "word " * 30_000 + "abc" * 2_000


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns whose names operators use."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox.", "en", 5, "a"),
        (1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox.", "en", 5, "a"),
        (2, None, "en", None, None),
        (3, "", "de", 0, ""),
        (4, " \t\n\x0b ", None, 1, "b"),
        (None, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox.", None, 2, "c"),
        (None, None, None, None, None),
        (5, LONG, "en", 7, "d"),
        (6, "Écoute  ça, l'été finit… 漢字 😀 1²Ⅷ <|end|> \\", "fr", 7, "e"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp int, IDS string")


@pytest.fixture(scope="session")
def no_rows(edge):
    return edge.limit(0)
