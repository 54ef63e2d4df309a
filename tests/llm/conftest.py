from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n: int, seed: int) -> str:
    """``n`` words that do not repeat in the same order."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(f"{WORDS[x >> 16 & 15]}{x % 997}")
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and blank texts, ties, repeats, one long word, one long text, clashing column names."""
    base = prose(120, 1)
    return [
        (1, base, "en", "a", 9),
        (2, base, "en", "a", 9),
        (2, base, "en", "a", 9),
        (3, base.replace("alpha", "omega", 1), "en", "b", 9),
        (4, None, "en", "a", 9),
        (5, "", None, "a", 9),
        (6, " \t\n ", "de", None, 9),
        (7, "x" * 30_000, "de", "b", None),
        (8, prose(6000, 2) + "\n" + prose(200, 2), "de", "b", 9),
        (9, "naïve 中文 😀 text\x00with\x1codd blanks  and   runs\r\n\r\n", "fr", "c", 9),
        (None, prose(60, 3), "fr", "c", 9),
        (11, prose(60, 3), "fr", "c", 9),
        (12, "two words", "fr", "c", 9),
        (13, "Two WORDS", "fr", "c", 9),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, ids string, k string, size string, root string, start long"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame([(*r, 1, "i", "k", "s", "r", 2) for r in odd_rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
