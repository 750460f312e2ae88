import random

import pytest

DOCS = "doc_id long, text string, kept string, id string, digest string, text_sha256 string, n_words string"


@pytest.fixture
def docs(spark):
    """A documents frame from (doc_id, text) pairs, with extra columns whose names clash with those of the operators."""

    def make(pairs):
        return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in pairs], DOCS)

    return make


def prose(seed, words, vocabulary=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))
