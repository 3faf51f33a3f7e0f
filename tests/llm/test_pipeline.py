"""Every stage of the corpus pipeline against a brute-force version, on its own input, and the whole of it."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from alpenglow.llm import byte_bpe, poisson_mix, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, bad=0):
    syllables = ["an", "the", "or", "ed", "ing", "on", "st", "re", "he", "ble"]
    rude = ["vilebrat", "grubsnout", "muckface", "sludgeling"]
    out = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(bad):
        out.insert(rng.randrange(len(out)), rng.choice(rude))
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """Documents with toxic ones, exact and near copies, shared passages, nulls, empty texts and repeated rows; and labels."""
    rng = random.Random(3)
    rows, labels = [], []
    passage = words(rng, 60)
    for k in range(500):
        bad = k % 4 == 0
        rows.append((k, words(rng, rng.randint(20, 120), 6 if bad else 0), "en", f"s{k % 3}"))
        labels.append((k, 1, int(bad)))
    for k in range(500, 540):
        rows.append((k, f"{words(rng, 30)} {passage} {words(rng, 30)}", "en", "s0"))
    clean = [t for k, t, _, _ in rows if k % 4 == 1 and k < 500]
    rows += [(600 + k, clean[3], "en", "s1") for k in range(30)]  # exact copies
    rows += [(700 + k, clean[5].replace(" ", "  ", 1) + (" the" if k else ""), "en", "s2") for k in range(3)]  # near copies
    rows += [(800, None, None, None), (801, "", "en", "s0"), (802, "", "en", "s1"), (None, words(rng, 40), "en", None),
             (803, clean[7], "en", "s1"), (803, clean[7], "en", "s1"), (804, words(rng, 9000), "en", "s2")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], labels


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    rows, labels = corpus
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage is given, and in the end what the pipeline returns, as rows."""
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in cp.STAGES:
        seen.append([tuple(r) for r in docs.select(*COLUMNS).collect()])
        docs = cp.written(stage(spark, docs, folder))
    return [*seen, docs.collect()]


def test_toxic_documents_go(spark, folder, corpus, stages):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 5], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, known)
    compressors = model.compressors()
    kept = [r for r in rows if model.score([(r[1] or "").encode()], compressors)[0] < cp.TOXIC]
    assert Counter(stages[1]) == Counter(kept)
    toxic = {i for i, _, t in labels if t}
    assert len([r for r in stages[1] if r[0] in toxic]) < 0.1 * len(toxic)
    assert len([r for r in stages[1] if r[0] not in toxic]) > 0.97 * len([r for r in rows if r[0] not in toxic])


def simhash(text):
    own = (text or "").lower().split()
    grams = [" ".join(own[k : k + 3]) for k in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_one_of_each_near_duplicate_group_stays(stages):
    rows = stages[1]
    prints = [simhash(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(root(k), []).append(r)
    want = [min((r for r in own if r[0] is not None), key=lambda r: r[0], default=own[0]) for own in groups.values()]
    assert Counter(stages[2]) == Counter(want)
    assert len([r for r in stages[2] if 600 <= (r[0] or 0) < 700]) == 0 and len([r for r in stages[2] if r[0] == 803]) == 0


def cut(texts, length):
    counts = Counter(x[k : k + length] for x in texts for k in range(len(x) - length + 1))
    out = []
    for x in texts:
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if counts[x[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out.append(bytes(b for b, g in zip(x, gone, strict=True) if not g).decode(errors="ignore"))
    return out


def test_repeated_passages_are_cut(stages):
    rows = stages[2]
    texts = cut([(r[1] or "").encode() for r in rows], cp.PASSAGE)
    want = [(r[0], None if r[1] is None else t, r[2], r[3], r[4] if r[1] is None else len(t)) for r, t in zip(rows, texts, strict=True)]
    assert Counter(stages[3]) == Counter(want)
    assert any(a[1] != b[1] for a, b in zip(sorted(rows, key=repr), sorted(want, key=repr), strict=True))
    before, after = ({i: len(t or "") for i, t, *_ in x} for x in (rows, stages[3]))
    assert all(after[k] < 0.75 * before[k] for k in range(500, 540) if k in after)  # the shared passage of sixty words is gone


def copies(key, rate):
    parts = max(1, math.ceil(rate / poisson_mix.PART))
    total = 0
    for j in range(1, parts + 1):
        u = (int(hashlib.md5(f"{cp.SEED}:{key}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p = 0, math.exp(-rate / parts)
        while u > p:
            k += 1
            p += math.exp(-rate / parts + k * math.log(rate / parts) - math.lgamma(k + 1))
        total += k
    return total


def test_sources_are_mixed(stages):
    rows, size = stages[3], Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "")
    filled = [s for s, n in size.items() if n]
    rate = {s: sum(size.values()) / len(filled) / n if n else 0.0 for s, n in size.items()}
    want = Counter()
    for r in rows:
        want[r] += copies("" if r[0] is None else r[0], rate[r[3]]) if rate[r[3]] else 0
    assert Counter(stages[4]) == +want


def test_texts_become_ids(stages):
    path = cp.BPE_PATH
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load(path, public_tokenizers.PATTERN).ranks, special_tokens={})
    found = Counter((r["doc_id"], r["lang"], r["source"], r["n_tokens"], tuple(r["ids"]), r["round_trip"]) for r in stages[5])
    want = Counter()
    for i, text, lang, source, _ in stages[4]:
        ids = tuple(library.encode_ordinary(text or ""))
        want[i, lang, source, len(ids), ids, True] += 1
    assert found == want


def test_the_run_is_its_stages(spark, folder, stages):
    assert Counter(map(repr, cp.run(spark, folder).collect())) == Counter(map(repr, stages[5]))


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_stages_take_empty_tables_and_further_columns(spark, folder, corpus, name, stage):
    docs = spark.createDataFrame(corpus[0][:80] + corpus[0][-8:], SCHEMA)
    wide = docs.withColumns({"score": F.lit("s"), "fp": F.lit("f"), "row": F.lit(1), "copy": F.lit(2), "ids": F.lit("i"), "__other": F.lit(3)})
    plain, more = stage(spark, docs, folder), stage(spark, wide, folder)
    assert stage(spark, docs.limit(0), folder).collect() == []
    assert sorted(map(repr, more.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    if name != "byte_bpe":
        assert plain.columns == COLUMNS and set(more.columns) >= set(COLUMNS)


def test_texts_go_to_python_once(spark, monkeypatch):
    given, decode = [], byte_bpe.decode
    monkeypatch.setattr(byte_bpe, "decode", lambda frame, *more: (given.append(frame.columns), decode(frame, *more))[1])
    docs = spark.createDataFrame([(1, "the one", "en", "s", 7), (2, None, "en", "s", None), (3, "", "en", "s", 0)], SCHEMA)
    found = {r["doc_id"]: (r["n_tokens"] > 0, r["round_trip"]) for r in cp.tokenize(spark, docs, "").collect()}
    assert found == {1: (True, True), 2: (False, True), 3: (False, True)}
    assert "text" not in given[0]
