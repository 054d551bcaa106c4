"""Small frames for the pipeline operators."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema)
    return frame


def doc(i, text, source="a"):
    return (i, text, "en", source, len(text or ""))


def prose(seed, n=80, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(random.Random(k).choices("abcdefghijklmnop", k=2 + k % 7)) for k in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
