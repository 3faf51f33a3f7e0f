from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from alpenglow.llm import simhash_ball as s


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps):
    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in distance <= 3])
        if (new == label).all():
            return label
        label = new


def scattered(seed, centres=25, near=12):
    rng = np.random.default_rng(seed)
    out = []
    for centre in rng.integers(0, 2**64, centres, dtype=np.uint64):
        out.append(int(centre))
        for _ in range(near):
            bits = rng.choice(64, rng.integers(1, 6), replace=False)
            out.append(int(centre) ^ sum(1 << int(b) for b in bits))
        for block in range(4):
            out.append(int(centre) ^ sum(1 << int(b) for b in block * 16 + rng.choice(16, 3, replace=False)))
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("seed", range(4))
def test_links_connect_what_brute_force_connects(spark, seed):
    fps = scattered(seed)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in s.fingerprint_links(frame).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    place = {int(x): k for k, x in enumerate(fps)}
    label = list(range(len(fps)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in edges:
        x, y = sorted((root(place[a]), root(place[b])))
        label[y] = x
    assert [root(k) for k in range(len(fps))] == brute_classes(fps).tolist()


def test_every_pair_of_three_bits_is_found():
    base = np.uint64(0x0123456789ABCDEF)
    rng = np.random.default_rng(2)
    for _ in range(300):
        other = base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
        fps = np.unique(np.array([base, other]))
        keys, block, plain = s.variants(fps)
        a, b = s.links(keys.ravel(), np.repeat(fps, keys.shape[1]), np.tile((block * 2 + plain).astype(np.uint8), 2))
        assert len(a) and {int(a[0]), int(b[0])} == {int(base), int(other)}


def test_a_large_group_makes_few_edges():
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    fps = np.unique(np.array([centre ^ (1 << int(a)) ^ (1 << int(b)) for a in range(64) for b in range(64)], np.uint64))
    keys, block, plain = s.variants(fps)
    n = keys.shape[1]
    a, _ = s.links(keys.ravel(), np.repeat(fps, n), np.tile((block * 2 + plain).astype(np.uint8), len(fps)))
    assert len(a) < 30 * n * len(fps) / 10 and len(fps) == 2017


def test_components_of_documents(spark, documents, prose):
    texts = [prose(1), prose(1), prose(1).upper(), prose(2), "", None, " \n\t", "one", "One", "two words", prose(3) + " tail", (None, prose(3) + " tail"),
             (None, "alone without id and with its own words"), (40, prose(9)), (40, prose(9)), (40, prose(8))]
    frame = documents(*texts, extra="'x' AS fp")
    rows = s.components(frame).collect()
    assert len(rows) == len(texts)
    given = [(r["doc_id"], r["text"]) for r in frame.collect()]
    fps = np.array([brute_fingerprint(t) for _, t in given], np.uint64)
    label = brute_classes(fps)
    least = {k: min((i for (i, _), lb in zip(given, label, strict=True) if lb == k and i is not None), default=None) for k in set(label.tolist())}
    want = sorted((repr(i), int(f), repr(least[lb])) for (i, _), f, lb in zip(given, fps, label.tolist(), strict=True))
    assert sorted((repr(r["doc_id"]), r["fp"] & (2**64 - 1), repr(r["component_id"])) for r in rows) == want
    kept = s.keep_one(frame).collect()
    assert len(kept) == len(least) and frame.columns == s.keep_one(frame).columns
    assert {r["doc_id"] for r in kept} == set(least.values())
    assert s.components(frame.limit(0)).count() == 0 and s.keep_one(frame.limit(0)).count() == 0


def test_chains_reach_their_smallest_id(spark):
    from alpenglow.llm.components import smallest_reachable

    rng = np.random.default_rng(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (200, 150), (7, 7)] + [(300, int(x)) for x in rng.integers(301, 400, 40)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in smallest_reachable(frame).collect()}
    assert all(found[k] == 0 for k in range(61)) and found[200] == found[150] == 100
    assert {found[b] for a, b in edges if a == 300} == {300}
