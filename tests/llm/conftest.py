import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns filled in."""

    def make(rows, lang="en", source="s"):
        return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture
def prose():
    """Repeatable invented prose."""

    def make(seed, words, vocabulary=4000):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary):x}" for _ in range(words))

    return make


@pytest.fixture
def edited():
    """A text with some of its words replaced."""

    def make(text, seed, times):
        draw, parts = random.Random(seed), text.split(" ")
        for _ in range(times):
            parts[draw.randrange(len(parts))] = f"e{seed}x{draw.randrange(10**6)}"
        return " ".join(parts)

    return make
