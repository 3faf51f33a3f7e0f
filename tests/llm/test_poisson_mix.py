from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest

from alpenglow.llm import poisson_mix


def drawn(seed, key, rate):
    parts = max(1, math.ceil(rate / poisson_mix.PART))
    total = 0
    for j in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}:{key}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p = 0, math.exp(-rate / parts)
        while u > p:
            k += 1
            p += math.exp(-rate / parts + k * math.log(rate / parts) - math.lgamma(k + 1))
        total += k
    return total


@pytest.mark.parametrize("epochs", [0.5, 3.0, 70.0])
def test_copies_follow_the_inverted_distribution(spark, epochs):
    rows = [(k, "x" * (k % 7 + 1), "big" if k % 3 else "small") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text)
    rate = {s: 0.5 * epochs * sum(size.values()) / n for s, n in size.items()}
    want = {k: n for k, _, s in rows if (n := drawn(9, k, rate[s]))}
    found = poisson_mix.replicate(docs, epochs=epochs, seed=9).collect()
    assert Counter(r["doc_id"] for r in found) == want
    assert [r["order_key"] for r in found] == sorted(r["order_key"] for r in found)
    assert all(sorted(r["copy"] for r in found if r["doc_id"] == k) == list(range(1, n + 1)) for k, n in list(want.items())[:20])


def test_weights_choose_and_exclude_sources(spark):
    docs = spark.createDataFrame([(k, "abcd", "a" if k < 200 else "b") for k in range(400)], "doc_id bigint, text string, source string")
    found = poisson_mix.replicate(docs, {"a": 3.0}, epochs=1.0)
    assert {r["source"] for r in found.collect()} == {"a"} and 330 < found.count() < 470


def test_nulls_empty_texts_repeats_and_clashes(spark, documents):
    frame = documents(None, "", "abc", "abc", (None, "abcd"), (2, "abc"), extra="7 AS copies")
    found = poisson_mix.replicate(frame.selectExpr("*", "1 AS copy"), epochs=4.0, seed=1).collect()
    per = Counter((r["doc_id"], r["copy"]) for r in found)
    assert per[(2, 1)] == 2  # rows of one id are drawn alike
    assert poisson_mix.replicate(documents("", None)).count() == 0  # no volume
    assert poisson_mix.replicate(frame.limit(0)).count() == 0
    orphan = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, source string")
    assert poisson_mix.replicate(orphan, epochs=50.0).count() > 20  # a null source is a source
