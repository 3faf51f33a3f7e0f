from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpenglow.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text or ""))


def brute(text, items, window=10):
    """(n_words, hit places, items) of one text."""
    own, hit, met = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        m = min(window, len(theirs))
        grams = {tuple(theirs[k : k + m]) for k in range(len(theirs) - m + 1)} if m else set()
        for k in range(len(own) - m + 1):
            if tuple(own[k : k + m]) in grams:
                hit |= set(range(k, k + m))
                met.add(item)
    return len(own), hit, met


def check(rows, texts, items, window=10):
    got = sorted(((r.doc_id, r.n_words, {k for s in r.spans for k in range(s.a, s.b)}, set(r.items)) for r in rows), key=repr)
    assert got == sorted(((k, *brute(t, items, window)) for k, t in texts), key=repr)
    for r in rows:  # merged, in order
        assert all(x.b < y.a for x, y in zip(r.spans[:-1], r.spans[1:], strict=True))


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, text string")


def planted(seed, n_items=12, n_docs=80):
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(names) for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 30])))) for k in range(n_items)]
    texts = []
    for k in range(n_docs):
        own = [rng.choice(names + [f"x{j}" for j in range(200)]) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            theirs = words(rng.choice(items)[1])
            a = rng.randint(0, max(len(theirs) - 5, 0))
            at = rng.randint(0, len(own))
            own[at:at] = theirs[a : a + rng.randint(5, 30)]
        texts.append((k, " ".join(x.upper() if rng.random() < 0.2 else x for x in own)))
    return items, texts


@pytest.mark.parametrize("seed", [1, 2])
def test_find_against_brute_force(documents, items, seed):
    given_items, texts = planted(seed)
    check(dc.find(documents(*texts).repartition(3), items(*given_items)).collect(), texts, given_items)


def test_blocks_of_items_add_up(documents, items, monkeypatch):
    given_items, texts = planted(3)
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (25,))
    assert len(list(dc.item_blocks(dc.item_words(items(*given_items))))) > 2
    check(dc.find(documents(*texts), items(*given_items)).collect(), texts, given_items)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=4), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=9), min_size=1, max_size=4),
       st.integers(1, 6), st.integers(1, 50))
def test_wu_manber_finds_every_window(texts, items, window, stretch):
    """Words of few kinds, so that blocks repeat and shifts are short; lanes shorter than a window."""
    built = dc.Windows([[str(x).encode() for x in item] for item in items], window)
    code = np.array([built.known.get(str(x).encode(), 0) for text in texts for x in text], np.int64)
    before = dc.STRETCH
    dc.STRETCH = stretch
    try:
        hit, met = dc._found(code, np.array([len(x) for x in texts]), [(dc.WuManber(p), own) for p, own in built.sets])
    finally:
        dc.STRETCH = before
    at = 0
    for text, own in zip(texts, met, strict=True):
        _, places, found = brute(" ".join(map(str, text)), [(k, " ".join(map(str, x))) for k, x in enumerate(items)], window)
        assert set(np.flatnonzero(hit[at : at + len(text)]).tolist()) == places and own == found
        at += len(text)


def test_shifts_skip_most_positions():
    rng = np.random.default_rng(1)
    machine = dc.WuManber(rng.integers(1, 5000, (3000, 10)))
    code = np.where(rng.random(100_000) < 0.3, rng.integers(1, 5000, 100_000), 0)
    looked = []
    shift = machine.shift

    class Counted:
        def __getitem__(self, at):
            looked.append(len(at))
            return shift[at]

    machine.shift = Counted()
    assert len(machine.ends(code, dc._hashes(code, machine.block), np.array([0, len(code)]))) < 2000
    assert sum(looked) < 25_000


def test_nulls_repeats_empty_tables_and_other_columns(documents, items):
    texts = [(1, None), (2, ""), (3, "?! --"), (4, "one two"), (4, "one two"), (None, "ONE, two three")]
    given_items = [(7, "one two"), (7, "two three"), (8, ""), (9, None)]
    docs = documents(*texts, extra="1 AS spans").withColumns({"items": F.lit(2), "n_words": F.lit(3), "__items": F.lit(4)})
    rows = dc.find(docs, items(*given_items).withColumn("words", F.lit(1))).collect()
    check(rows, texts, given_items)
    assert {tuple(r["items"]) for r in rows} == {(), (7,)}
    assert dc.find(documents(), items(*given_items)).collect() == []
    assert [(r.n_words, r.spans) for r in dc.find(documents("a b"), items()).collect()] == [(2, [])]
    kept = dc.clean(docs, items(*given_items))
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3"]


def test_very_long_text(documents, items):
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(30)]
    own = [rng.choice(["a", "b", "c", "p1", "p2"]) for _ in range(300_000)]
    own[2040:2040] = passage  # over the border of a stretch
    own[200_000:200_000] = passage[5:15]
    row = dc.find(documents(" ".join(own)), items((1, " ".join(passage)))).first()
    assert [(s.a, s.b) for s in row.spans] == [(2040, 2070), (200_000, 200_010)] and row["items"] == [1]


def test_a_passage_in_every_text_and_many_items(documents, items):
    passage = " ".join(f"w{k}" for k in range(12))
    texts = [(k, f"u{k} {passage} v{k}") for k in range(300)]
    given_items = [(k, f"{passage} z{k}") for k in range(40)]
    rows = dc.find(documents(*texts), items(*given_items)).collect()
    assert all([(s.a, s.b) for s in r.spans] == [(1, 13)] and sorted(r["items"]) == list(range(40)) for r in rows)
