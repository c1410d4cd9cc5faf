"""A table with the awkward rows that every operator has to take."""

import random

import pytest

WORDS = [a + b + c for a in ("ba", "ke", "lo", "mi") for b in ("ra", "ste", "nu", "vi", "do") for c in ("", "n", "l", "shi", "t")]


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank and very long texts, repeated rows, NULL and repeated ids, extra columns with clashing names."""
    long = prose(1, 30_000)
    rows = [
        (0, None), (1, ""), (2, "   \n\t"), (3, "one"), (4, long), (5, long), (5, long), (6, "…!?"), (None, "a text without an id at all"),
        (None, None), (7, prose(2, 40)), (7, prose(3, 40)), (8, "É é ß Straße naïve 数字 🙂🙂 x\x01y <|endoftext|>"), (9, "word" * 5000),
        (10, "the end.\r\nnext,line. Σίσυφος ΣΑΣ"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", "s", "x", 1.0, "y", "z") for i, t in rows], "doc_id long, text string, lang string, source string, `word` string, score double, `hash` string, uid string"
    ).coalesce(2)
