from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts (ids from 0) or (id, text) pairs."""

    def make(*texts, extra=""):
        rows = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts)]
        rows = [(i, t, "en", f"s{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        frame = spark.createDataFrame(rows, DOCUMENTS)
        return frame.selectExpr("*", extra) if extra else frame

    return make


@pytest.fixture
def prose():
    """Invented text of some words, the same for the same seed."""

    def make(seed, words=60, letters="abcdefgh"):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(words))

    return make
