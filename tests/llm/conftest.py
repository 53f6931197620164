import pytest

#: Awkward texts: (doc_id, text, lang, source).
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n\x0b\x0c\r ", None, "a"),
    (4, "One", "en", "b"),
    (5, "one two", "en", "b"),
    (6, "word " * 30000, "en", "a"),
    (7, "x" * 60000, "en", "c"),
    (8, "1-" * 20000 + "1", "de", "c"),
    (9, "Écoutez, c'est l'été à l'école! " * 5, "fr", "a"),
    (10, "mail me: a.b@c.de, d@e.f.g\nIP 1.2.3.4 and 300.1.1.1, card 4111 1111 1111 1111, tel +1 (743) 555-3824.", "en", "b"),
    (10, "mail me: a.b@c.de, d@e.f.g\nIP 1.2.3.4 and 300.1.1.1, card 4111 1111 1111 1111, tel +1 (743) 555-3824.", "en", "b"),
    (None, "no id here <|endoftext|> J\u030c ǅ 中文字", "en", "b"),
    (11, "日本語 のテキスト ١٢٣ 1.2.3.4", "ja", "ü"),
    (12, "same line\nsame line\n\nsame line\nother", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, repeated rows, empty and very long texts and a column that clashes with inner names."""
    rows = [(i, t, lang, s, None if t is None else len(t), "clash", 7, *"abcdef") for i, t, lang, s in ROWS]
    inner = ", ".join(f"{c} string" for c in ("_hit", "_gone", "_lang_pred", "_lang_score", "_whole", "_spans"))
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, id string, n int, {inner}")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
