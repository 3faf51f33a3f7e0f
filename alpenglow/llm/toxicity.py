"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Fitting takes a bounded sample of labelled rows (SAMPLE of each class by the hash of their ids; texts over LONGEST
characters are left out of the fit, never of the scoring). Two thirds of it train the dictionaries: a shared part on
ordinary text, then an own part on the words that recur (after RECURS different words at least) in one class and hardly in the
other. A toxic and an ordinary dictionary are the shared part with the class' own part. The other third calibrates: of
every window of a text (words up to WINDOW bytes, A-Z in lower case) the gain is its compressed length with the ordinary
dictionary less that with the toxic one; the counts of windows whose gain reaches each of GAINS, and their shares, enter
a logistic regression weighted to the classes' shares of the labels.

Scores lie in 0 to 1. Null and empty texts have no windows and get the score of the bare intercept. Without labels of
both classes every score is the toxic share of the labels (0 without any). A document labelled twice counts as toxic if
one label says so; null labels don't count. Other columns of the documents are left out of scoring.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alpenglow.llm.common import chunks, encoded

#: Labelled rows of each class that a fit takes at most.
SAMPLE = 8000
LONGEST = 20_000
WINDOW = 40
SHARED_BYTES, OWN_BYTES = 32_768, 8_192
RECURS = 5
#: The same as a share of the class' training texts; the larger of the two counts.
RECURS_SHARE = 0.02
#: How many times likelier a word must be in its own class.
OWN_RATIO = 10
GAINS = (1, 2, 3, 4, 5, 6, 8)
RIDGE = 0.5
#: Text scored at once.
SCORED_BYTES = 500_000
_WORD = re.compile(rb"[^\s.,;:!?|()\"]+")
_PARAMETERS = {"window_log": 18, "hash_log": 17, "chain_log": 17, "search_log": 4, "min_match": 3, "target_length": 32,
               "strategy": zstandard.STRATEGY_BTOPT, "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0,
               "format": zstandard.FORMAT_ZSTD1_MAGICLESS}


def windows(text: bytes) -> list[bytes]:
    """The text cut before words, in pieces of WINDOW bytes or the word that passes them."""
    out, at, size = [], 0, len(text)
    lower = text.lower()
    while at < size:
        end = _next_word(lower, at + WINDOW) if at + WINDOW < size else size
        out.append(lower[at:end])
        at = end
    return out


def _next_word(text: bytes, at: int) -> int:
    space = text.find(b" ", at)
    line = text.find(b"\n", at, len(text) if space < 0 else space)
    stop = line if line >= 0 else space
    return len(text) if stop < 0 else stop + 1


@dataclass
class Model:
    """What scoring needs; without weights the score is the prior."""

    prior: float
    ordinary: bytes = b""
    toxic: bytes = b""
    header: bytes = b""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        made = []
        for data in (self.ordinary, self.toxic):
            kept = zstandard.ZstdCompressionDict(data + self.header, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.append(zstandard.ZstdCompressor(
                dict_data=kept, compression_params=zstandard.ZstdCompressionParameters(**_PARAMETERS)))
        return tuple(made)

    def features(self, texts: list[bytes], compressors) -> np.ndarray:
        split = [windows(x) for x in texts]
        counts = np.array([len(x) for x in split])
        all_windows = [self.header + w for x in split for w in x]  # the header keeps short windows compressible
        gains = np.zeros(len(all_windows), np.int64)
        for start in range(0, len(all_windows), 10_000):
            some = all_windows[start : start + 10_000]
            plain, toxic = (np.array([len(x) for x in c.multi_compress_to_buffer(some)]) for c in compressors)
            gains[start : start + len(some)] = plain - toxic
        row = np.repeat(np.arange(len(texts)), counts)
        columns = [np.ones(len(texts))]
        for least in GAINS:
            n = np.bincount(row[gains >= least], minlength=len(texts)).astype(float)
            columns += [np.log1p(n), n / np.maximum(counts, 1), np.minimum(n, 1)]
        return np.stack([*columns, np.log1p(counts)], axis=1)

    def score(self, texts: list[bytes], compressors) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        z = ((self.features(texts, compressors) - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _recurrence(texts: list[bytes]) -> dict[bytes, int]:
    """After how many different words a word occurs; copies of a text add nothing."""
    before: dict[bytes, set] = defaultdict(set)
    for text in texts:
        words = _WORD.findall(text.lower())
        for previous, word in zip([b"", *words], words, strict=False):
            before[word].add(hash(previous))
    return {word: len(x) for word, x in before.items()}


def _own_part(texts: list[bytes], own: dict[bytes, int], other: dict[bytes, int], ratio: float) -> bytes:
    """A dictionary of the words of one class' texts that recur there and hardly in the other class."""
    least = max(RECURS, RECURS_SHARE * len(texts))
    words = {w for w, n in own.items() if n >= least and len(w) >= 4 and OWN_RATIO * ratio * other.get(w, 0) < n}
    samples = [b" " + b" ".join(found) + b" " for text in texts if (found := [w for w in _WORD.findall(text.lower()) if w in words])]
    listed = b" ".join([b"", *sorted(words, key=lambda w: (own[w], w)), b""])[-OWN_BYTES:]
    try:
        trained = zstandard.train_dictionary(OWN_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        trained = b""
    return (trained + listed)[-OWN_BYTES:].rjust(OWN_BYTES, b"\0")


def _regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    mean[0], scale[0] = 0.0, 1.0
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE)
    ridge[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, z.T @ (weight * (p - y)) + ridge * w)
        w = w - np.clip(step, -2, 2)
    return mean, scale, w


def fit_texts(rows: list[tuple[int, bytes, int]], share: float) -> Model:
    """A model of (hash, text, toxic) rows; share: of toxic among all labels."""
    train = [[x for h, x, t in rows if h % 3 and t == k] for k in (0, 1)]
    held = [(x, t) for h, x, t in rows if h % 3 == 0]
    if not all(train) or len({t for _, t in held}) < 2:
        return Model(share)
    recurs = [_recurrence(x) for x in train]
    sizes = [sum(map(len, x)) for x in train]
    samples = [w for text in train[0] for w in re.findall(rb"(?s).{1,128}", text.lower())]
    try:
        shared = zstandard.train_dictionary(SHARED_BYTES, samples[:: 1 + len(samples) // 100_000]).as_bytes()
    except zstandard.ZstdError:
        shared = b"".join(samples)[-SHARED_BYTES:]
    header = b" ".join([b"", *sorted(recurs[0], key=lambda w: (-recurs[0][w], w))[:8], b""])[:32]
    model = Model(share, shared + _own_part(train[0], recurs[0], recurs[1], sizes[0] / sizes[1]),
                  shared + _own_part(train[1], recurs[1], recurs[0], sizes[1] / sizes[0]), header)
    x = model.features([t for t, _ in held], model.compressors())
    y = np.array([t for _, t in held], float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.mean, model.scale, model.weights = _regression(x, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits on the labels given; pass only those to learn from."""
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("t"))
    known = known.select(F.col(doc_id).alias("doc_id"), (F.col("t") > 0).cast("int").alias("t"),
                         F.pmod(F.xxhash64(doc_id), F.lit(2**31)).alias("h"))
    totals = {r["t"]: r["n"] for r in known.groupBy("t").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return Model(0.0)
    share = totals.get(1, 0) / sum(totals.values())
    chosen = [known.filter(F.col("t") == k).orderBy("h", "doc_id").limit(SAMPLE) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # 2 * SAMPLE rows at most
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.char_length("text") <= LONGEST)
    rows = some.join(F.broadcast(chosen), "doc_id").select("doc_id", "h", "t", "text").collect()
    rows = sorted((r["h"], r["doc_id"], r["text"].encode(), r["t"]) for r in rows)
    return fit_texts([(h // 7, x, t) for h, _, x, t in rows], share)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with their texts' scores; a column named like `out` is replaced."""
    kept = [x for x in docs.schema.fields if x.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors() if model.weights is not None else None
        for batch in batches:
            for piece in chunks(batch, text, SCORED_BYTES):
                value = model.score(encoded(piece.column(text)), compressors)
                yield pa.RecordBatch.from_arrays([*(piece.column(x.name) for x in kept), pa.array(value)], schema=None,
                                                 names=[*(x.name for x in kept), out])

    return docs.mapInArrow(run, schema)
