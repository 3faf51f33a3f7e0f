"""SimHash near-duplicates by balls that meet in the middle.

A fingerprint has a bit set where more than half of the text's shingle hashes have it set. Two fingerprints at most
`radius` bits apart meet in a variant that is half the radius from each. With an odd radius (3 as a rule) the halves are
one flipped bit and half of another: every fingerprint emits, for each of BLOCKS blocks of bits, the fingerprint with that
block masked, as it is and with each other bit flipped. Of a pair at distance 3 one differing bit falls into the mask and
either side flips one of the other two. Fingerprints that share a variant are verified by their whole distance.

In a group that shares a variant all pairs are never formed. Fingerprints with the same masked bits are within 2 bits of
each other (a flip each): all are linked to one of them. Those one masked bit apart are within 3 bits: one of each is
linked, found by looking up the flipped value. Three bits in the one block are found among the fingerprints that agree in
all others (no flip) by looking up each value (2**16 at most) with three bits flipped. So the work and the edges of a group
grow as its members, and no component is lost.

Whole texts are tokenised as A-Z lower-cased words; null and empty texts and those without words have fingerprint zero and
link like any other. Each row is returned with the component of its own fingerprint, repeated ids too; a null id stays
null and names a component only if all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alpenglow.llm.common import chunks, encoded, partitions, written
from alpenglow.llm.components import smallest_reachable

SHINGLE = 3
RADIUS = 3
BLOCKS = 4
BITS = 64
WIDTH = BITS // BLOCKS
SEED = 42
#: Fingerprints whose variants a task emits at once.
BATCH = 1024
#: Variants of a bucket, which one task holds.
BUCKET_BYTES = 4_000_000


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    return int(simhashes([text], shingle)[0])


def simhashes(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned fingerprints of texts."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = text.lower().split()  # of bytes: A-Z only, and white space \x09-\x0d and \x20
        parts = [words[k:] for k in range(shingle)]
        grams = map(b" ".join, zip(*parts, strict=False)) if len(words) >= shingle else ([b" ".join(words)] if words else [])
        before = len(hashes)
        hashes.extend([digest(x, SEED) for x in grams])
        counts.append(len(hashes) - before)
    out, total = np.zeros(len(texts), np.uint64), np.array(counts, np.int64)
    values = np.array(hashes, np.uint64)
    starts = np.cumsum(total) - total
    some = np.flatnonzero(total)
    if len(some):
        for bit in range(BITS):
            ones = np.add.reduceat((values >> np.uint64(bit)).astype(np.uint8) & 1, starts[some], dtype=np.int64)
            out[some] |= (2 * ones > total[some]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", out: str = "fp") -> DataFrame:
    """The rows with the fingerprint of their whole text as a long; a column so named is replaced."""
    kept = [x for x in docs.schema.fields if x.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                value = simhashes(encoded(piece.column(text)), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(piece.column(x.name) for x in kept), pa.array(value)], names=[*(x.name for x in kept), out])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.LongType(), False)]))


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all variants (a row a fingerprint), the block that each column masks, and whether it has no flip."""
    keys, blocks, plain = [], [], []
    for block in range(BLOCKS):
        mask = np.uint64(((1 << WIDTH) - 1) << (block * WIDTH))
        rest = fps & ~mask
        flips = [0] + [1 << b for b in range(BITS) if b // WIDTH != block]
        keys.append((rest[:, None] ^ np.array(flips, np.uint64)) | np.uint64(block) << np.uint64(block * WIDTH))
        blocks.append(np.full(len(flips), block))
        plain.append(np.arange(len(flips)) == 0)
    return np.concatenate(keys, axis=1), np.concatenate(blocks), np.concatenate(plain)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _emit(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """For each bucket of keys: (key and block, fingerprint, no flip) of the variants that fall into it, packed."""
    for batch in batches:
        all_fps = np.asarray(batch.column(0)).view(np.uint64)
        for start in range(0, len(all_fps), BATCH):
            fps = all_fps[start : start + BATCH]
            keys, block, plain = variants(fps)
            n = keys.shape[1]
            keys, owner = keys.ravel(), np.repeat(fps, n)
            flag = np.tile((block * 2 + plain).astype(np.uint8), len(fps))
            bucket = (_mixed(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            rows = np.zeros(len(keys), [("key", "<u8"), ("fp", "<u8"), ("flag", "u1")])
            rows["key"], rows["fp"], rows["flag"] = keys[order], owner[order], flag[order]
            packed = [(b, rows[a:z].tobytes()) for b, (a, z) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if z > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary())], names=["bucket", "rows"])


def _stars(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every row to the first row of its key (both sorted by key)."""
    head = np.r_[True, np.any(key[1:] != key[:-1], axis=1)]
    first = value[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    return value[~head], first[~head]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def links(key: np.ndarray, fp: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, among the members of each (key, block), all that are at most 3 bits apart through it."""
    none = np.zeros(0, np.uint64)
    if not len(key):
        return none, none
    block, plain = flag.astype(np.uint64) >> np.uint64(1), (flag & 1).astype(bool)
    order = np.lexsort((fp, key, block))
    block, key, fp, plain = block[order], key[order], fp[order], plain[order]
    head = np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
    group = np.cumsum(head) - 1
    shared = np.bincount(group)[group] > 1
    if not shared.any():
        return none, none
    block, fp, plain, group = block[shared], fp[shared], plain[shared], group[shared]
    masked = (fp >> (block * np.uint64(WIDTH))) & np.uint64((1 << WIDTH) - 1)
    combined = (np.cumsum(np.r_[True, group[1:] != group[:-1]]) - 1).astype(np.uint64) << np.uint64(WIDTH) | masked
    order = np.argsort(combined, kind="stable")
    combined, fp, plain = combined[order], fp[order], plain[order]
    found = [_stars(combined[:, None], fp)]
    values, first = np.unique(combined, return_index=True)
    found.append(_flipped(values, fp[first], [1 << b for b in range(WIDTH)]))
    exact = np.flatnonzero(plain)
    if len(exact):
        values, first = np.unique(combined[exact], return_index=True)
        rest = (values >> np.uint64(WIDTH)).astype(np.int64)
        several = np.bincount(rest)[rest] > 1
        triples = [1 << a | 1 << b | 1 << c for a in range(WIDTH) for b in range(a) for c in range(b)]
        found.append(_flipped(values[several], fp[exact][first][several], triples))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    near = _popcount(a ^ b) <= RADIUS
    return a[near], b[near]


def _flipped(values: np.ndarray, owner: np.ndarray, flips: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links of owners whose (sorted, distinct) values differ by one of the flips."""
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    if len(values) > 1:
        for flip in flips:
            other = values ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = (values[at] == other) & (other > values)
            a.append(owner[hit])
            b.append(owner[at[hit]])
    return np.concatenate(a), np.concatenate(b)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """a, b: enough links between fingerprints (longs, distinct) at most RADIUS bits apart to connect all that are.

    Buckets of keys are as many as the number of fingerprints asks for, so what a task holds of one does not grow with them."""
    spread = BLOCKS * (BITS - WIDTH + 1) * 17  # bytes that a fingerprint's variants take
    buckets = max(partitions(fps.sparkSession), -(-fps.count() * spread // BUCKET_BYTES))
    packed = fps.select("fp").repartition(buckets).mapInArrow(lambda batches: _emit(batches, buckets), "bucket int, rows binary")

    def run(group: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(group.column("rows").to_pylist()), [("key", "<u8"), ("fp", "<u8"), ("flag", "u1")])
        a, b = links(rows["key"], rows["fp"], rows["flag"])
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table({"a": both[:, 0].view(np.int64), "b": both[:, 1].view(np.int64)})

    return packed.groupBy("bucket").applyInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints (doc_id, fp), and each fingerprint's component (fp, component_id, class: one of its fingerprints)."""
    found = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle).select("doc_id", "fp"))
    named = written(found.groupBy("fp").agg(F.min("doc_id").alias("first")))  # copies are one fingerprint from here on
    reach = smallest_reachable(fingerprint_links(named))
    placed = named.join(reach, named["fp"] == reach["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    least = placed.groupBy("class").agg(F.min("first").alias("component_id"))
    return found, placed.join(least, "class").select("fp", "component_id", "class")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long), component_id: the smallest id whose fingerprint is reachable by links."""
    found, placed = classes(docs, doc_id, text, shingle)
    return found.join(placed.drop("class"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of which one of each component stays: that of the smallest id (of a component without ids, one of the
    rows whose fingerprint names it). Of rows that agree in id and fingerprint, one stays."""
    found, placed = classes(docs, doc_id, text, shingle)
    known = found.join(placed, "fp").filter(
        (F.col("doc_id") == F.col("component_id")) | (F.col("component_id").isNull() & (F.col("class") == F.col("fp"))))
    # of one id's rows in one component, the smallest fingerprint's
    kept = written(known.groupBy("class", "doc_id").agg(F.min("fp").alias("__fp"), F.count("*").alias("__rows")))
    marked = fingerprints(docs, shingle, text, "__own_fp")
    on = marked[doc_id].eqNullSafe(kept["doc_id"]) & (marked["__own_fp"] == kept["__fp"])
    out = marked.join(kept, on, "left_semi")
    if kept.filter("__rows > 1").limit(1).count():
        out = out.dropDuplicates([doc_id, "__own_fp"])
    return out.drop("__own_fp")
