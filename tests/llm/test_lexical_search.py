from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alpenglow.llm import lexical_search as ls
from alpenglow.llm.words import words

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text or ""))


def brute(docs, items, k):
    """[(item, rank, doc_id, score)] of items [(id, text)] over documents [(id, text)]."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total, df = len(bags), sum(sum(b.values()) for _, b in bags), Counter(x for _, b in bags for x in b)
    out = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            m = 100 - 50 + 50 * sum(bag.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * bag[x] // (1000 * bag[x] + 20 * m))
                for x in set(terms(text)) if x in bag)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def ranked(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, text string")


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    names = [f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(2000)]
    return [" ".join(rng.choice(names) for _ in range(int(rng.paretovariate(0.8)) % 300)) for _ in range(n)]


@pytest.mark.parametrize("text", ["", "Hello, WORLD!", "a1-b2_c3", "éÀ ñandú\x00x", "日本 語", "İstanbul ÀB"])
def test_words(text):
    assert [x.decode() for x in words(text.encode())] == terms(text)


def test_search_against_brute_force(documents, items):
    texts = corpus(1, 400)
    queries = [(k, t) for k, t in enumerate(corpus(2, 30))]
    docs = documents(*texts).repartition(5)
    want = brute(list(enumerate(texts)), queries, 7)
    assert ranked(ls.search(docs, items(*queries), k=7)) == want


def test_small_blocks_of_documents_and_items_give_the_same(documents, items, monkeypatch):
    texts, queries = corpus(3, 200), [(k, t) for k, t in enumerate(corpus(4, 12))]
    terms_frame = ls.item_terms(items(*queries))
    blocks = list(ls.item_blocks(terms_frame, 10))
    assert len(blocks) > 2 and sorted(x for b in blocks for x, _ in b) == [k for k, t in queries if terms(t)]
    monkeypatch.setattr(ls.item_blocks, "__defaults__", (10,))
    monkeypatch.setattr(ls.index, "__defaults__", ("doc_id", "text", 2000))
    assert ranked(ls.search(documents(*texts), items(*queries), k=5)) == brute(list(enumerate(texts)), queries, 5)


def test_copies_ties_and_repeats(documents, items):
    texts = ["same words here"] * 60 + ["same words", "words words words"] + ["filler text"] * 200
    rng = random.Random(5)
    rows = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    queries = [(1, "same words"), (1, "same words"), (2, "Words, WORDS"), (3, "nothing known"), (4, ""), (5, None)]
    got = ranked(ls.search(documents(*rows), items(*queries), k=50))
    assert got == brute(rows, queries, 50)
    assert [r[2] for r in sorted(r for r in got if r[0] == 2)[:2]] == [61, 60]


def test_nulls_empty_tables_and_other_columns(documents, items):
    rows = [(None, "apple pie"), (3, None), (4, ""), (5, "--- !!"), (6, "apple pie"), (7, "apple"), (8, "plum")]
    docs = documents(*rows, extra="7 AS score").withColumns({"rank": F.lit(1), "item": F.lit(2), "n_docs": F.lit(3), "held": F.lit(4)})
    asked = items((1, "apple pie")).withColumns({"terms": F.lit("x"), "doc_id": F.lit(9)})
    assert ranked(ls.search(docs, asked)) == brute(rows, [(1, "apple pie")], 50)
    assert ls.search(documents(), asked).collect() == []
    nothing = ls.search(docs, items())
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]


def test_very_long_text(documents, items):
    long = " ".join(corpus(6, 3000)) + " needle"
    rows = [(0, long), (1, "needle"), (2, "w1 w2"), (3, "needle w1 " * 50)]
    assert ranked(ls.search(documents(*rows), items((9, "needle w1 w2")))) == brute(rows, [(9, "needle w1 w2")], 50)


def test_strata_are_left_out_once_they_cannot_win():
    """Few long documents with a rare term, many strata without: visited lists end before them, and the best are right."""
    rng = np.random.default_rng(1)
    length = np.sort(rng.integers(5, 4000, 3000))
    held, df = np.array([1, 2]), np.array([3000, 100])
    doc = np.concatenate([np.arange(3000), np.sort(rng.choice(3000, 100, replace=False))])
    tf = np.concatenate([np.ones(3000, np.int64), np.full(100, 4)])
    weight = np.array([0, 5, 3000])
    strata = ls.Strata(length, held, df, doc, tf, 3000, int(length.sum()), weight)
    visited = []
    add = ls.np.unique
    try:
        ls.np.unique = lambda x, **how: visited.append(len(x)) or add(x, **how)
        docs, scores = strata.best([1, 2], 20, np.arange(3000))
    finally:
        ls.np.unique = add
    assert sum(visited) < 1500
    m = 50 + 50 * length * 3000 // length.sum()
    score = 5 * (10**9 // (1000 + 20 * m)) + np.isin(np.arange(3000), doc[3000:]) * 3000 * (4 * 10**9 // (4000 + 20 * m))
    want = np.lexsort((np.arange(3000), -score))[:20]
    assert docs.tolist() == want.tolist() and scores.tolist() == score[want].tolist()
