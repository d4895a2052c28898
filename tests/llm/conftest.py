import pytest


@pytest.fixture(scope="session")
def long_text():
    """About 300,000 characters in one line."""
    return " ".join(f"wort{k % 977} some{k % 31}, thing{k}" for k in range(12000))


@pytest.fixture(scope="session")
def docs(spark, long_text):
    """Null ids, texts and sources, empty and long texts, ties and repeated rows."""
    rows = [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (1, "other text here", "en", "s"), (2, None, None, None), (None, "x y z\n\nx", None, "s"),
            (None, None, None, None), (3, "", "de", "t"), (4, long_text, "en", "t"), (5, " \t\n ", "de", None), (6, "123 !! #*$", None, "t"),
            (7, "Ünïcode ΣΑΣ <|endoftext|> İstanbul é\n", "de", "t")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
