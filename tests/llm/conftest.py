import random

import pytest

LATIN = "the of and to in that it is was for on are with as his they at be this from have or by one had not but what all".split()


def words(seed, n):
    """Invented words; the same seed gives the same words."""
    rng = random.Random(seed)
    return [rng.choice(LATIN) if rng.random() < 0.3 else "".join(rng.choices("abdefgilmnoprstuv", k=rng.randint(3, 9))) for _ in range(n)]


def text(seed, n):
    return " ".join(words(seed, n))


@pytest.fixture
def docs(spark):
    """Documents from rows of (doc_id, text[, source]); with a column that no operator knows."""

    def make(rows):
        full = [(i, t, "en", (rest or ["s"])[0], len(t or ""), "x") for i, t, *rest in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, size string"
        )

    return make
