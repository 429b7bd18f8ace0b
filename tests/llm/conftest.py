import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["the", "of", "and", "to", "in"] * 6 + ["".join(rng.choice("aeioulrstn") for _ in range(rng.randrange(3, 9))) for _ in range(200)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, odd white space, ties and repeated rows."""
    long = prose(7, 30_000)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", None, None, None),
        (4, prose(1, 80), "en", "a", None),
        (5, prose(1, 80), "en", "a", None),
        (5, prose(1, 80), "en", "a", None),
        (6, prose(1, 79) + " changed", None, "b", 3),
        (None, prose(2, 60), "fr", "b", 4),
        (None, None, None, None, None),
        (7, long, "en", "c", len(long)),
        (8, long + " end", "en", "c", 1),
        (9, "one two", "en", None, 7),
        (10, "ONE two", "de", None, 7),
        (11, "Ünïcödé ß 日本語 😀 x y ▁ \x1c", "de", "d", 20),
        (12, "a b c a b c\na b c\n\n a b c", "en", "d", 1),
        (13, '### $$$ %%% <|> & "token": abcdefgh12345', "xx", "d", 2),
        (-14, "token=" + "0123456789abcdef" * 3 + " AKIA" + "Z" * 14, "en", "e", 2),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
