"""Small texts and tables, and rows as dictionaries."""

import random

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(rows):
        full = [(doc_id, text, "en", "src", len(text or "")) for doc_id, text in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


def sentence(seed, words=60, vocabulary=400):
    """Words that depend on the seed alone."""
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(words))


def by(frame, key, *names):
    """Rows as a dictionary by one column."""
    return {row[key]: tuple(row[name] for name in names) for row in frame.collect()}
