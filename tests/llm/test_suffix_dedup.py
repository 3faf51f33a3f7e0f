from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpenglow.llm import suffix_dedup as d
from alpenglow.llm.difference_cover import ranks


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.integers(1, 80))
def test_ranks_order_suffixes(symbols, depth):
    found = ranks(np.array(symbols, np.int64), depth)
    suffix = [tuple(symbols[k:]) for k in range(len(symbols))]
    for a, x in enumerate(suffix):
        for b, y in enumerate(suffix):
            if x[:depth] < y[:depth]:
                assert found[a] < found[b]
    if depth >= 2 * len(symbols) + 3:
        assert found.tolist() == [sum(y < x for y in suffix) for x in suffix]


def brute(texts, length):
    """(kept, removed, runs) of each text, window by window."""
    counts = Counter(x[k : k + length] for x in texts for k in range(len(x) - length + 1))
    out = []
    for x in texts:
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if counts[x[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(x, gone, strict=True) if not g), sum(gone), runs))
    return out


@pytest.mark.parametrize("most", [3000, 1])
@pytest.mark.parametrize("length, gram", [(40, 8), (65, 64)])
def test_removed_bytes_as_brute_force(spark, prose, monkeypatch, most, length, gram):
    monkeypatch.setattr(d, "MOST", most)
    monkeypatch.setattr(d, "SORT_BYTES", 4000)
    shared, other = prose(100, 40), prose(101, 25, "aé")
    texts = [prose(1), shared, prose(2, 9) + shared + prose(3, 9), shared[30:] + shared[:90], other + other, "a" * 300, "ab" * 200,
             prose(5, 9) + other, "", "short", "x" * length, "x" * (length - 1), prose(1)[10:200] + "?" + prose(1)[200:], "ü" * 150, prose(4, 30, "ab")]
    texts += [prose(k, 5) + shared + prose(k + 50, 5) for k in range(200, 212)]
    keys = d.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "doc_id", "text")
    spans = d.with_spans(keys, d.repeated_spans(keys, length, gram))
    found = {r["doc_id"]: d.cut(r["text"].encode(), [(s["a"], s["b"]) for s in r["__spans"] or []]) for r in spans.collect()}
    assert [found[k] for k in range(len(texts))] == brute([x.encode() for x in texts], length)


def test_whole_copies_nulls_and_repeated_rows(spark, documents, prose):
    long, own = prose(1, 200), prose(2, 200)
    frame = documents(long, long, own, None, "", "short", "short", (None, prose(3, 200)), (None, prose(3, 200)), (9, prose(4, 200)), (9, prose(4, 200)),
                      extra="1 AS row")
    rows = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in d.report(frame).collect()}
    size = lambda x: len(x.encode())
    assert rows == {(0, size(long), size(long), 1), (1, size(long), size(long), 1), (2, size(own), 0, 0), (3, 0, 0, 0), (4, 0, 0, 0), (5, 5, 0, 0), (6, 5, 0, 0),
                    (None, size(prose(3, 200)), size(prose(3, 200)), 1), (9, size(prose(4, 200)), size(prose(4, 200)), 1)}
    kept = {(r["doc_id"], r["text"]) for r in d.remove(frame).collect()}
    assert kept == {(0, ""), (1, ""), (2, own), (3, None), (4, ""), (5, "short"), (6, "short"), (None, ""), (9, "")}
    assert d.remove(frame).columns == frame.columns and d.remove(frame).count() == 11
    assert d.report(frame.limit(0)).count() == 0


def test_cut_merges_and_counts():
    assert d.cut(b"0123456789", [(6, 8), (1, 3), (2, 4), (4, 5)]) == (b"05" + b"89", 6, 2)
    assert d.cut(b"abc", []) == (b"abc", 0, 0)


def test_a_passage_in_most_texts_is_cut_into_parts(spark, prose, monkeypatch):
    """Hot cells and hot runs are salted on both sides, and give what brute force gives."""
    shared = prose(1, 60)
    texts = [shared] * 40 + [prose(k, 3) + " " + shared + " " + prose(k + 100, 3) for k in range(40)] + [prose(k, 40) for k in range(300, 320)]
    keys = d.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "doc_id", "text")
    found, small = [], []
    real = d._with_hot

    def watched(rows, few, on, size):
        total = few.agg(F.sum(size)).first()[0]
        found.append(few.filter(F.col(size) > total / 32).count())
        out = real(rows, few, on, size)
        small.append((out.count(), rows.join(few.select(*on), on).count()))
        return out

    monkeypatch.setattr(d, "_with_hot", watched)
    spans = d.with_spans(keys, d.repeated_spans(keys, 65, 16))
    cut = {r["doc_id"]: d.cut(r["text"].encode(), [(s["a"], s["b"]) for s in r["__spans"] or []]) for r in spans.collect()}
    assert [cut[k] for k in range(len(texts))] == brute([x.encode() for x in texts], 65)
    assert min(found) > 0 and all(a == b for a, b in small)


def test_spans_are_merged_before_they_are_gathered(spark):
    rows = [(1, 5, 0, 4), (1, 5, 3, 9), (1, 5, 9, 10), (1, 5, 12, 14), (1, None, 1, 2), (1, None, 0, 5), (2, 5, 0, 1)]
    frame = spark.createDataFrame(rows, "row bigint, doc_id bigint, a bigint, b bigint")
    assert sorted(map(tuple, d.merged_spans(frame).collect()), key=repr) == sorted(
        [(1, 5, 0, 10), (1, 5, 12, 14), (1, None, 0, 5), (2, 5, 0, 1)], key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 30)), max_size=40), st.integers(1, 12), st.integers(1, 60))
def test_pieces_end_where_a_cell_does(rows, per_batch, size):
    rows = sorted(rows)
    batch = pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([b"x" * n for _, n in rows], pa.binary())], names=["cell", "bytes"])
    pieces = [x.to_pylist() for x in d._by_cells((batch.slice(k, per_batch) for k in range(0, len(rows), per_batch)), size)]
    assert [r for x in pieces for r in x] == batch.to_pylist()
    cells = [{r["cell"] for r in x} for x in pieces]
    assert all(not (a & b) for a, b in zip(cells[:-1], cells[1:], strict=True))
    for x in pieces[:-1]:
        own = sum(len(r["bytes"]) for r in x)
        assert own >= size
    for x in pieces:  # no piece could have ended earlier
        last = x[-1]["cell"]
        assert sum(len(r["bytes"]) for r in x if r["cell"] != last) < size


@pytest.mark.parametrize("most", [3000, 1])
@pytest.mark.parametrize("lengths, gram", [((40, 65), 8), ((33, 70), 32), ((64, 200), 64)])
def test_two_lengths_as_brute_force(spark, prose, monkeypatch, most, lengths, gram):
    """One search tells the repeated strings of both lengths, next to the ends of texts and of passages too."""
    monkeypatch.setattr(d, "MOST", most)
    monkeypatch.setattr(d, "SORT_BYTES", 4000)
    shared, other = prose(100, 40), prose(101, 12, "aé")
    texts = [prose(1), shared, prose(2, 9) + shared + prose(3, 9), shared[30:] + shared[:90], other + other, "a" * 300, "ab" * 200, "", "short",
             prose(5, 9) + other, *("x" * n for x in lengths for n in (x, x - 1)), prose(1)[10:200] + "?" + prose(1)[200:], "ü" * 150, prose(1)[-50:], "\0" * 90]
    texts += [prose(k, 5) + shared[: 3 * (k - 180)] + prose(k + 50, 5) for k in range(200, 212)] + [prose(1)[7:60], shared[-45:], shared[-45:]]
    rows = [(k, x) for k, x in enumerate(texts)] + [(3, texts[3]), (None, shared[:50]), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    keys = d.keyed(frame, "doc_id", "text")
    spans = d.with_spans(keys, d.repeated_spans(keys, lengths[1], gram, passage=lengths[0])).collect()
    found = Counter()
    for r in spans:
        x, given = r["text"].encode(), r["__spans"] or []
        long = d.cut(x, [(s["a"], s["b"]) for s in given if s["size"] == lengths[1]])
        found[(x, long, d.cut(x, [(s["a"], s["b"]) for s in given])[1])] += 1
    given = [(x or "").encode() for _, x in rows]
    short = [x[1] for x in brute(given, lengths[0])]
    assert found == Counter(zip(given, brute(given, lengths[1]), short, strict=True))
    assert short != [x[1] for x in brute(given, lengths[1])]


def test_passages_of_fifty_words_are_counted(spark, documents, prose):
    """Passages of over fifty words are under the 400 bytes that are removed, and are told apart from clean texts."""
    passages = [prose(k, 52) for k in range(3)]
    assert all(d.PASSAGE < len(x) < d.LENGTH for x in passages)
    clean = [prose(k, 150) for k in range(10, 16)]
    planted = [f"{prose(20 + k, 80)} {passages[k % 3]} {prose(40 + k, 80)}" for k in range(9)]
    rows = {r["doc_id"]: r for r in d.report(documents(*clean, *planted, None)).collect()}
    assert [rows[k]["n_repeated"] for k in range(len(clean))] == [0] * len(clean) and rows[len(clean) + 9]["n_repeated"] == 0
    for k in range(9):
        found = rows[len(clean) + k]
        assert found["n_removed"] == 0 and len(passages[k % 3]) <= found["n_repeated"] < d.LENGTH
