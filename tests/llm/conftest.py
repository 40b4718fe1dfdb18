import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("hits", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("repeats", T.StringType()),
        T.StructField("text_bytes", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("n_words", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash."""

    def make(pairs, lang="en"):
        rows = [(i, t, lang, "src0", len(t or ""), "x", "x", "x", "x", "x", "x") for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make


def sentence(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and very long texts, repeated rows, ties, odd white space."""
    long_text = sentence(1, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "word"),
        (5, sentence(5, 60)),
        (5, sentence(5, 60)),
        (6, sentence(5, 60)),
        (7, "A b  C\x0bd\n\né 漢字 😀 " + sentence(5, 60)),
        (8, long_text),
        (9, long_text),
        (None, sentence(9, 40)),
        (10, "the " * 500),
    ]
