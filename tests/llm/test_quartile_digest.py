from __future__ import annotations

import hashlib

import pytest

from alpenglow.llm import quartile_digest as q


def brute_codes(text):
    """Bucket codes by counting one byte triplet at a time."""
    counts = [0] * q.BUCKETS
    for a, b, c in zip(text, text[1:], text[2:], strict=False):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
        h ^= h >> 15
        counts[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 25] += 1
    order = sorted(counts)
    cuts = [order[q.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    return [sum(n > x for x in cuts) for n in counts]


def test_codes_as_brute_force(prose):
    texts = [prose(k, 5 * k).encode() for k in range(8)] + [b"", b"ab", b"abc", "ünïcödé".encode() * 30]
    code, _ = q.codes(texts)
    assert code.tolist() == [brute_codes(x) for x in texts]


def test_likeness_is_bounded_and_grows_with_what_is_shared(spark, documents, prose):
    base = prose(1, 400)
    half = base[: len(base) // 2] + prose(2, 200)
    frame = q.fingerprint(documents(base, base, half, prose(3, 400, "uvwxyz"), "", None))
    prints = [r["fingerprint"] for r in frame.orderBy("doc_id").collect()]
    assert prints[0] == prints[1] and prints[4] == prints[5]
    pairs = spark.createDataFrame([(prints[0], x, 1) for x in prints] + [(None, "", 1)], "a string, b string, likeness int")
    like = [r["likeness"] for r in q.compare(pairs, "a", "b").collect()]
    assert like[0] == like[1] == like[6] == 1.0 and 1 > like[2] > like[3] >= 0


@pytest.mark.parametrize("ids", [[3, 1, 2, 9, 7, 5], [None, 4, 4, 8], [6], []])
def test_next_document_by_id(spark, ids, prose):
    rows = [(i, prose(k, 9 + k) if k != 1 else None) for k, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS fingerprint")
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for k, (i, text) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()))
    found = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in q.edited_pairs(frame).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_every_boundary_between_ranges(spark, prose):
    rows = [(7 * k % 101, prose(k, 12)) for k in range(101)]
    found = {r["doc_id"]: r for r in q.edited_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    texts = dict(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in q.fingerprint(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(found) == 101
    for i in range(101):
        after = (i + 1) % 101
        n = len(texts[i]) // 2
        assert found[i]["edited_sha256"] == hashlib.sha256((texts[i][: len(texts[i]) - n] + texts[after][:n]).encode()).hexdigest()
        assert found[i]["fingerprint"] == prints[i]
        assert found[i]["near_next"] == q.likeness(*q.codes([texts[i].encode()]), *q.codes([texts[after].encode()]))[0]


def test_more_ranges_than_rows_and_thousands_of_partitions(spark, prose):
    """What a task is given about the ranges stays flat, however many there are."""
    rows = [(k * k, prose(k, 6)) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(map(tuple, q.edited_pairs(frame).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert sorted(map(tuple, q.edited_pairs(frame).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
