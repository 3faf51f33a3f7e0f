from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from alpenglow.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENCODING = byte_bpe.load(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODING.ranks, special_tokens={})


def ids_of(text):
    ids, bounds = ENCODING.encode([text])
    return ids[: bounds[1]].tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300) | st.text(alphabet="ab c's", max_size=400))
def test_as_the_library(text):
    ids = ids_of(text)
    assert ids == LIBRARY.encode_ordinary(text)
    data, ends = ENCODING.decode(np.array(ids, np.int64), np.array([0, len(ids)]))
    assert data == text.encode() and ends.tolist() == [0, len(data)]


@pytest.mark.parametrize("piece", ["a" * 5000, "ab" * 2000, "the" * 700, "aab" * 500, "é" * 900, "!?" * 300, " " * 3000 + "x"])
def test_long_pieces_as_the_library(piece):
    assert ids_of(piece) == LIBRARY.encode_ordinary(piece)


def test_pair_table_finds_every_pair_and_no_other():
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 50, 400).astype(np.int32), rng.integers(0, 50, 400).astype(np.int32)
    pairs = dict(zip(zip(left.tolist(), right.tolist(), strict=True), range(400), strict=True))
    table = byte_bpe.PairTable(*(np.array(x, np.int32) for x in zip(*((a, b, r) for (a, b), r in pairs.items()), strict=True)))
    a, b = (x.ravel().astype(np.int32) for x in np.mgrid[-1:51, -1:51])
    assert table.find(a, b).tolist() == [pairs.get(k, byte_bpe.NONE) for k in zip(a.tolist(), b.tolist(), strict=True)]


def test_frames_with_nulls_copies_and_clashing_columns(spark, documents):
    frame = documents(None, "", "hello world", "hello world", (None, "x y"), extra="'old' AS ids")
    found = byte_bpe.encode(frame, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    both = byte_bpe.decode(found.selectExpr("*", "1 AS decoded"), PATH, public_tokenizers.PATTERN)
    rows = both.collect()
    assert len(rows) == 5
    for row in rows:
        assert row["ids"] == LIBRARY.encode_ordinary(row["text"] or "") and bytes(row["decoded"]) == (row["text"] or "").encode()
    assert byte_bpe.encode(frame.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(byte_bpe.decode(nothing, PATH, public_tokenizers.PATTERN).first()["decoded"]) == b""


def test_forgetting_changes_nothing(monkeypatch, prose):
    texts = [prose(k) for k in range(6)]
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 40)
    assert [ids_of(x) for x in texts] == [LIBRARY.encode_ordinary(x) for x in texts]


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError, match="outside"):
        ENCODING.decode(np.array([50_300]), np.array([0, 1]))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcthe", min_size=129, max_size=600) | st.text(alphabet="é日a", min_size=60, max_size=300))
def test_any_long_piece_as_the_library(piece):
    assert ENCODING.merge_long(piece.encode()).tolist() == LIBRARY._core_bpe.encode_single_piece(piece.encode())


def test_a_piece_of_a_million_bytes():
    piece = "thequickbrownfox" * 62_500
    ids = ENCODING.merge_long(piece.encode())
    assert ENCODING.decode(ids.astype(np.int64), np.array([0, len(ids)]))[0] == piece.encode()


def test_a_batch_is_encoded_in_small_pieces():
    seen = []

    class Watched:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)

    frame = SimpleNamespace(schema=T.StructType([T.StructField("text", T.StringType())]), mapInArrow=lambda run, schema: run)
    byte_bpe.worker_cache()["bpe watched x"] = Watched()
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 100_000] * 12})
    assert sum(piece.num_rows for piece in byte_bpe.encode(frame, "watched", "x")(iter([batch]))) == 12
    assert max(seen) <= byte_bpe.TEXT_BYTES == 500_000
