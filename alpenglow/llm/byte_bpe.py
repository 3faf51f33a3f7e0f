"""Byte-level BPE: encode and decode whole texts by a table of ranks.

Pieces (matches of the pattern) are encoded on their own. Distinct pieces are put into padded matrices by length; in each
round every row merges its leftmost pair of minimum rank, ranks come from one hashed lookup of the changed pairs, rows
are shifted left over the merged token, and finished rows leave the matrix. A worker keeps the encoding of the pieces it
has met in a table of bounded size, which changes nothing but the time.

Long pieces (a row of their own) merge the same pairs in the same order, the leftmost of minimum rank first, from a heap of
(rank, place): their time grows as n log n, whatever the text is.

Null and empty texts have no ids and decode to no bytes. Ids outside the table raise on decoding.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from alpenglow.llm.common import chunks, worker_cache

NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Widths of the matrices; a piece of more bytes is encoded on its own.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 128)
ROWS = 20_000
#: Bits of a place in a long piece.
_PLACE = 40
#: Bytes of text that a worker encodes at once: their pieces, places and ids take many times as much.
TEXT_BYTES = 500_000
#: Pieces a worker remembers.
REMEMBERED = 300_000


class PairTable:
    """Open-addressed table from a pair of ids to the rank of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = self._key(left, right)
        self.shift = np.uint64(64 - max(4, int(2 * max(1, len(keys)) - 1).bit_length() + 1))
        size = 1 << (64 - int(self.shift))
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        slot, rest = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(rest):
            self.probes += 1
            free = rest[self.keys[slot[rest]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.ranks[slot[placed]] = keys[placed], rank[placed]
            rest = np.setdiff1d(rest, placed, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & (size - 1)

    @staticmethod
    def _key(left, right) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where there is none; a negative id (padding) forms no pair."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), self._key(left, right)).ravel()
        out, slot, rest = np.full(len(keys), NONE, np.int32), self._slot(keys), np.flatnonzero(keys != -2)
        mask = len(self.keys) - 1
        for _ in range(self.probes):
            there = self.keys[slot[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.ranks[slot[rest[hit]]]
            rest = rest[~hit & (there != -1)]
            if not len(rest):
                break
            slot[rest] = (slot[rest] + 1) & mask
        return out.reshape(left.shape)


class Encoding:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_id = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.bytes_id[token[0]] = rank
        splits = [
            (ranks[t[:k]], ranks[t[k:]], rank)
            for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        ]
        self.pairs = PairTable(*(np.array(x, np.int32) for x in zip(*splits, strict=True))) if splits else PairTable(
            *(np.zeros(0, np.int32),) * 3)
        top = max(ranks.values()) + 1
        sizes = np.full(top, -1, np.int64)
        ordered = sorted((rank, token) for token, rank in ranks.items())
        for rank, token in ordered:
            sizes[rank] = len(token)
        self.size = sizes
        self.start = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        self.text = np.frombuffer(b"".join(t for _, t in ordered), np.uint8)
        self.forget()

    def merge(self, rows: np.ndarray) -> list[np.ndarray]:
        """Ids after all merges of each padded row (padding -1)."""
        done: list[np.ndarray | None] = [None] * len(rows)
        rank = self.pairs.find(rows[:, :-1], rows[:, 1:])
        active, ids = np.arange(len(rows)), rows
        while len(active):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rank)), at]
            over = best == NONE
            if over.any():
                for k, row, n in zip(active[over].tolist(), ids[over], (ids[over] >= 0).sum(axis=1).tolist(), strict=True):
                    done[k] = row[:n]
                keep = ~over
                active, ids, rank, at, best = active[keep], ids[keep], rank[keep], at[keep], best[keep]
                if not len(active):
                    break
            line = np.arange(len(active))
            ids[line, at] = best
            stay = np.ones(ids.shape, bool)
            stay[line, at + 1] = False
            ids = ids[stay].reshape(len(ids), -1)
            stay = np.ones(rank.shape, bool)
            stay[line, at] = False
            rank = rank[stay].reshape(len(rank), -1)
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.pairs.find(ids[has, at[has] - 1], ids[has, at[has]])
            has = np.flatnonzero(at < rank.shape[1])
            rank[has, at[has]] = self.pairs.find(ids[has, at[has]], ids[has, at[has] + 1])
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        token = [bytes([x]) for x in piece]
        rank_of, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [rank << _PLACE | at for at in range(n - 1) if (rank := rank_of(token[at] + token[at + 1])) is not None]
        heapq.heapify(heap)
        mask = (1 << _PLACE) - 1
        while heap:
            top = heapq.heappop(heap)
            at, right = top & mask, after[top & mask]
            # stale unless both are still there and are the pair that this rank was noted for
            if token[at] is None or right >= n or rank_of(merged := token[at] + token[right]) != top >> _PLACE:
                continue
            token[at], token[right] = merged, None
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
                if (rank := rank_of(merged + token[after[at]])) is not None:
                    heapq.heappush(heap, rank << _PLACE | at)
            if before[at] >= 0 and (rank := rank_of(token[before[at]] + merged)) is not None:
                heapq.heappush(heap, rank << _PLACE | before[at])
        return np.array([self.ranks[x] for x in token if x is not None], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        todo: list[list[int]] = [[] for _ in WIDTHS]
        fit = np.searchsorted(WIDTHS, np.arange(WIDTHS[-1] + 1)).tolist()
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = np.array([whole], np.int32)
            elif len(piece) > WIDTHS[-1]:
                out[k] = self.merge_long(piece)
            else:
                todo[fit[len(piece)]].append(k)
        for width, ks in zip(WIDTHS, todo, strict=True):
            for start in range(0, len(ks), ROWS):
                some = ks[start : start + ROWS]
                sizes = np.array([len(pieces[k]) for k in some])
                rows = np.full((len(some), width), -1, np.int32)
                rows[np.arange(width) < sizes[:, None]] = self.bytes_id[np.frombuffer(b"".join(pieces[k] for k in some), np.uint8)]
                for k, ids in zip(some, self.merge(rows), strict=True):
                    out[k] = ids
        return out

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (with the end as last entry)."""
        split = [self.pattern.findall(x) for x in texts]
        used = set().union(*split)
        new = used.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = used
        pieces = list(new)
        found = self.encode_pieces([p.encode() for p in pieces])
        self.known.update(zip(pieces, range(len(self.sizes), len(self.sizes) + len(pieces)), strict=True))
        sizes = np.array([len(x) for x in found], np.int64)
        self.flat = np.concatenate([self.flat, *found])
        self.sizes = np.concatenate([self.sizes, sizes])
        at = self.known.__getitem__
        counts = np.array([len(x) for x in split], np.int64)
        index = np.fromiter((at(p) for pieces in split for p in pieces), np.int64, int(counts.sum()))
        starts, sizes = (np.cumsum(self.sizes) - self.sizes)[index], self.sizes[index]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all ids, and where the bytes of each of the rows that `bounds` cuts begin and end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or (self.size[ids] < 0).any()):
            raise ValueError("an id outside the table")
        sizes = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        take = np.arange(ends[-1]) + np.repeat(self.start[ids] - ends[:-1], sizes)
        return self.text[take].tobytes(), ends[bounds]


def load(path: str, pattern: str) -> Encoding:
    """The encoding of a rank file, once a worker. The file is a part of every machine's installation, as the libraries are."""
    held, key = worker_cache(), f"bpe {path} {pattern}"
    if key not in held:
        with open(path, "rb") as lines:
            held[key] = Encoding({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)
    return held[key]


def encode(frame: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with a column of ids for each whole text; other columns stay (one named like `ids` is replaced)."""
    kept = [x for x in frame.schema.fields if x.name != ids]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for batch in batches:
            for piece in chunks(batch, text, TEXT_BYTES):
                texts = [x or "" for x in piece.column(text).to_pylist()]
                found, bounds = encoding.encode(texts)
                column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(x.name) for x in kept), column], names=[*(x.name for x in kept), ids])

    return frame.mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with the bytes that each row's ids stand for (null ids: none)."""
    kept = [x for x in frame.schema.fields if x.name != decoded]
    schema = T.StructType([*kept, T.StructField(decoded, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for batch in batches:
            column = batch.column(ids)
            for start in range(0, batch.num_rows, 500):
                some = column.slice(start, 500)
                sizes = np.asarray(pc.fill_null(pc.list_value_length(some), 0))
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                data, ends = encoding.decode(np.asarray(some.flatten(), dtype=np.int64), bounds)
                out = pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
                piece = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(x.name) for x in kept), out], names=[*(x.name for x in kept), decoded])

    return frame.mapInArrow(run, schema)
