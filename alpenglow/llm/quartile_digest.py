"""Quartile bucket digests of documents.

Every run of three bytes is hashed to one of BUCKETS buckets and counted; a bucket's code is the number of quartiles of
the counts that it exceeds (0 to 3). The digest is the length code (two hex digits) and the codes (two bits a bucket). The
likeness of two digests is 1 - min(difference, BOUND) / BOUND, the difference being the summed steps between codes plus
the steps between length codes. Equal texts have equal digests; texts under three bytes have only zero codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks, encoded, joined, map_batches, partitions

BUCKETS = 128
#: Differences from here on count as no likeness: half of what two digests without common codes can reach.
BOUND = 192.0
#: Texts of one length code differ by less than a quarter.
LENGTH_BASE = 1.25


def codes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket codes (a row each) and length codes of texts."""
    data, bounds = joined(parts)
    counts = np.zeros(len(parts) * BUCKETS, np.int64)
    if len(data) > 2:
        x = data.astype(np.uint32)
        mixed = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        bucket = ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(25)).astype(np.int64)
        row = np.repeat(np.arange(len(parts)), np.diff(bounds))
        within = row[:-2] == row[2:]
        counts += np.bincount((row[:-2] * BUCKETS + bucket)[within], minlength=len(counts))
    counts = counts.reshape(-1, BUCKETS)
    quartiles = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2).astype(np.uint8)
    length = np.minimum(np.floor(np.log1p(np.diff(bounds)) / np.log(LENGTH_BASE)), 255).astype(np.uint8)
    return code, length


def digests(code: np.ndarray, length: np.ndarray) -> list[str]:
    packed = code.reshape(len(code), -1, 4) @ np.array([64, 16, 4, 1])
    return [bytes(row).hex() for row in np.concatenate([length[:, None], packed.astype(np.uint8)], axis=1)]


def likeness(code_a, length_a, code_b, length_b) -> np.ndarray:
    steps = np.abs(code_a.astype(np.int16) - code_b).sum(axis=1) + np.abs(length_a.astype(np.int16) - length_b)
    return 1.0 - np.minimum(steps, BOUND) / BOUND


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths of digests; null is the digest of the empty text."""
    raw = bytes.fromhex("".join(x or "0" * (2 + BUCKETS // 2) for x in column.to_pylist()))
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 1 + BUCKETS // 4)
    return ((rows[:, 1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).reshape(len(rows), -1), rows[:, 0]


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of each whole text (null: empty)."""
    docs = docs.select(doc_id, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests(*codes(encoded(batch.column(1)))), pa.string())], names=[doc_id, "fingerprint"])

    return map_batches(docs, work, f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, fingerprint string", text)


def compare(pairs: DataFrame, left: str, right: str, out: str = "likeness") -> DataFrame:
    """doc-wise likeness (0 to 1) of two columns of digests; other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = likeness(*unpack(batch.column(left)), *unpack(batch.column(right)))
            kept = [x for x in batch.schema.names if x != out]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(value)], names=[*kept, out])

    pairs = pairs.drop(out)
    return pairs.mapInArrow(run, pairs.select("*", F.lit(0.0).alias(out)).schema)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in ranges of ids (long): __part, __tail, doc_id, text, sorted in each task, each range followed by the next
    range's first row as its tail (the last range by the first row of all).

    The driver holds one id for each range; where ranges begin is a frame of one row a range, which every task is given.
    Null ids come first; rows of one id are in the order of their texts.
    """
    n = partitions(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    cuts = docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = np.array(sorted({int(x) for x in cuts}), np.int64)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), side="right").astype(np.int32))

    placed = docs.withColumn("__part", part_of(F.coalesce("doc_id", F.lit(-(2**63)))))
    firsts = placed.groupBy("__part").agg(  # nulls come first, and min() skips them
        F.when(F.max(F.col("doc_id").isNull()), F.lit(None)).otherwise(F.min("doc_id")).alias("__first"))
    before = F.coalesce(F.lag("__part").over(Window.orderBy("__part")), F.max("__part").over(Window.partitionBy()))
    firsts = firsts.withColumn("__before", before).withColumnRenamed("__part", "__begins")
    on = (F.col("__part") == F.col("__begins")) & F.col("doc_id").eqNullSafe(F.col("__first"))
    own, tail = (F.struct(F.col(part).alias("part"), F.lit(is_tail).alias("tail")) for part, is_tail in (("__part", False), ("__before", True)))
    copies = F.when(F.col("__begins").isNotNull(), F.array(own, tail)).otherwise(F.array(own))
    rows = placed.join(F.broadcast(firsts), on, "left").select("doc_id", "text", F.explode(copies).alias("__c")).select(
        F.col("__c.part").alias("__part"), F.col("__c.tail").alias("__tail"), "doc_id", "text")
    return rows.repartition(n, "__part").sortWithinPartitions("__part", "__tail", "doc_id", "text")


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: its fingerprint, that of its edited text (the second half replaced by the next document's
    beginning), and the likeness to both the edited text and the next document. A single document is its own next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its successor
        for batch in batches:
            for piece in chunks(batch):
                rows = list(zip(*(piece.column(k).to_pylist() for k in range(4)), strict=True))
                firsts, nexts = [], []
                for row in rows:
                    if held is not None:
                        if held[0] == row[0] and not held[1]:
                            firsts.append(held)
                            nexts.append(row[3] or "")
                    held = row
                if firsts:
                    yield _edited([r[2] for r in firsts], [r[3] or "" for r in firsts], nexts)

    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_next(docs, doc_id, text).mapInArrow(run, schema)


def _edited(ids: list, texts: list[str], nexts: list[str]) -> pa.RecordBatch:
    edited = []
    for own, after in zip(texts, nexts, strict=True):
        half = len(own) // 2
        edited.append((own[: len(own) - half] + after[:half]).encode())
    own = codes([x.encode() for x in texts])
    last = codes([nexts[-1].encode()])
    following = tuple(np.concatenate([a[1:], b]) for a, b in zip(own, last, strict=True))
    gaps = [k for k in range(len(texts) - 1) if nexts[k] is not texts[k + 1]]  # a range's end inside the batch
    if gaps:
        redone = codes([nexts[k].encode() for k in gaps])
        following[0][gaps], following[1][gaps] = redone
    new = codes(edited)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in edited]), pa.array(digests(*own)), pa.array(digests(*new)),
         pa.array(likeness(*own, *new)), pa.array(likeness(*own, *following))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
