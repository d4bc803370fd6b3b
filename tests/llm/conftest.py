import random

import pytest

# nulls, empty and blank texts, ties, repeated rows, and columns with names used inside
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, h long, taken string, "
    "marks string, language string"
)


@pytest.fixture
def table(spark):
    """A function that makes a documents table with clashing extra columns from (id, text[, lang, source])."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "a")), 0, 0.5, 7, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def words():
    """A function that makes n words, the same ones for the same seed."""

    def make(seed, n):
        draw = random.Random(seed)
        return ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(2, 7))) for _ in range(n)]

    return make


@pytest.fixture
def odd(words):
    """Rows with copies, overlaps, nulls, blanks, short and long texts, repeated ids and rows."""
    a, b, c = (" ".join(words(s, 60)) for s in (1, 2, 3))
    long = " ".join(words(4, 30_000))
    return [
        (1, a), (2, f"{b} {a}"), (3, a[:200] + " ¤ " + a[200:]), (4, None), (5, ""), (6, " \t\n\x0b"), (7, "x"),
        (8, c), (8, c), (9, c), (10, f"{c}\n{c}\n{b}"), (11, long), (12, "q " + long[1000:]), (None, a), (13, "ab " * 90),
        (14, "ab " * 70), (15, a.upper()), (8, b),
    ]
