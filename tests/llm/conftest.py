import pytest

WORDS = {
    "en": "the of and with ing tion er that this from ould have".split(),
    "de": "der die und nicht schon eine unge mit zwischen wird ist zur".split(),
}


def prose(lang, seed, words=40):
    """Text of made-up words, the same for the same arguments."""
    import random

    draw = random.Random(f"{lang}{seed}")
    parts = WORDS[lang]
    made = ["".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


@pytest.fixture(scope="session")
def texts():
    return prose


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows and clashing names."""
    rows = [
        (1, prose("en", 1), "en", "a", 5, "x", 1.0),
        (1, prose("en", 1), "en", "a", 5, "x", 1.0),
        (2, None, "en", "a", None, None, None),
        (3, "", None, None, 0, "x", 1.0),
        (4, " \t\n ", "de", "b", 4, "x", 1.0),
        (None, prose("de", 2), "de", "b", 9, "x", 1.0),
        (5, "1234 !!! <|endoftext|> ---", "en", "*", 9, "x", 1.0),
        (6, prose("en", 3, 60_000), "en", "b", 9, "x", 1.0),
        (7, "naïve 日本語 \U0001f600 " * 3, None, "b", 9, "x", 1.0),
        (8, "a", "en", "c", 1, "x", 1.0),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, score double")


@pytest.fixture(scope="session")
def no_rows(odd_rows):
    return odd_rows.limit(0)
