"""Words of documents that repeat a benchmark, by Wu-Manber search over word codes.

1. Items become windows of WINDOW consecutive words (a shorter item: one window), each distinct window once with the items that
   hold it. Items are read in blocks of at most BLOCK_WORDS words (or one item), one after the other; each block is one more
   pass over the documents, which carry what was found so far, so what a task is given is bounded.
2. A task codes the words of its texts: the number of a window's word, or 0. Windows of one length m form a set of patterns. The
   shift table says, for the hash of the last BLOCK words read, how far the next window's end can be at least: m - BLOCK + 1
   where no window holds such a block. Positions move by these shifts, all texts (long ones cut into stretches that overlap) of
   a slice at a time, and so skip what cannot match.
3. Where the shift is 0 the block's hash selects a bucket of windows that end in it; those whose first block differs go, and of
   the others all words are compared directly.

A text's hits are word spans, merged; nothing is shuffled, and no text meets another, so neither copies nor a passage that is
in a third of all texts makes a task longer than its share of the text.

Null texts have no words; items without words have no window. Items that agree in id, null ids among them, count as one
item. Repeated documents are documents of their own. Other columns take no part; the names that `marked` adds are its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks, encoded
from alpenglow.llm.words import ranges, word_codes, words

WINDOW = 10
#: Words of a block of items.
BLOCK_WORDS = 500_000
#: Words of a block that shift tables are asked for.
BLOCK = 3
#: Entries of a shift table; hashes that collide share the smaller shift.
TABLE = 1 << 20
#: Words between the ends that one lane of a slice looks at.
STRETCH = 2048
#: Windows compared at once.
COMPARED = 500_000


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, words: all words of each item."""
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                found = pa.array([words(x) for x in encoded(piece.column(1))], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([piece.column(0), found], names=["item_id", "words"])

    return items.mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, words array<binary>")


def item_blocks(items: DataFrame, size: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """Items with words, as lists of (item_id, words) with at most `size` words (or one item) at a time."""
    held, count = [], 0
    for row in items.filter(F.size("words") > 0).toLocalIterator():
        if held and count + len(row["words"]) > size:
            yield held
            held, count = [], 0
        held.append((row["item_id"], [bytes(x) for x in row["words"]]))
        count += len(row["words"])
    if held:
        yield held


class Windows:
    """The distinct windows of some items: by length, their words' codes; and the items of each."""

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        self.known: dict[bytes, int] = {}
        coded = [[self.known.setdefault(x, len(self.known) + 1) for x in item] for item in items]
        owners: dict[tuple, list[int]] = {}
        for number, item in enumerate(coded):
            for at in range(max(len(item) - window, 0) + 1):
                own = owners.setdefault(tuple(item[at : at + window]), [])
                if not own or own[-1] != number:
                    own.append(number)
        self.sets = []
        for size in sorted({len(x) for x in owners}):
            some = [x for x in owners if len(x) == size]
            self.sets.append((np.array(some, np.int64), [owners[x] for x in some]))


def _hashes(code: np.ndarray, block: int) -> np.ndarray:
    """Hash of the `block` words that end at each place; the first places lack some and take 0 for them."""
    out = np.zeros(len(code), np.uint64)
    for back in range(block):
        own = np.concatenate([np.zeros(min(back, len(code)), np.int64), code[: len(code) - back]]).astype(np.uint64)
        out = (out ^ own) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out % np.uint64(TABLE)).astype(np.int64)


class WuManber:
    """Shift table and suffix buckets of patterns of one length."""

    def __init__(self, patterns: np.ndarray):
        self.m = patterns.shape[1]
        self.block = min(BLOCK, self.m)
        self.longest = self.m - self.block + 1
        self.shift = np.full(TABLE, self.longest, np.int64)
        flat = _hashes(patterns.ravel(), self.block).reshape(patterns.shape)
        for end in range(self.block - 1, self.m):
            np.minimum.at(self.shift, flat[:, end], self.m - 1 - end)
        order = np.argsort(flat[:, -1], kind="stable")
        self.order, self.suffix, self.prefix = order, flat[order, -1], flat[order, self.block - 1]
        self.patterns = patterns[order]

    def ends(self, code: np.ndarray, hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Places of texts' words (text k: bounds[k] to bounds[k + 1]) where a window may end: the shift is 0."""
        first, stop = bounds[:-1] + self.m - 1, bounds[1:]
        some = first < stop
        first, stop = first[some], stop[some]
        lanes = -(-(stop - first) // STRETCH)  # lanes of a text look at ends of their own
        number = ranges(np.zeros(len(lanes), np.int64), lanes)
        at = np.repeat(first, lanes) + number * STRETCH
        until = np.minimum(at + STRETCH, np.repeat(stop, lanes))
        found = []
        while len(at):
            step = self.shift[hashed[at]]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at < until
            at, until = at[on], until[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def matches(self, code: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of the last word, number of the window) of all occurrences, some at a time."""
        hashed = _hashes(code, self.block)
        ends = self.ends(code, hashed, bounds)
        low, high = (np.searchsorted(self.suffix, hashed[ends], side) for side in ("left", "right"))
        size = high - low
        ends, low, size = ends[size > 0], low[size > 0], size[size > 0]
        total, at = np.cumsum(size), 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + COMPARED, side="right")))
            end, entry = np.repeat(ends[at:stop], size[at:stop]), ranges(low[at:stop], size[at:stop])
            same = self.prefix[entry] == hashed[end - self.m + self.block]
            end, entry = end[same], entry[same]
            for back in range(self.m):  # direct comparison, dropped at the first difference
                same = code[end - back] == self.patterns[entry, self.m - 1 - back]
                end, entry = end[same], entry[same]
            yield end, self.order[entry]
            at = stop


def _found(code: np.ndarray, counts: np.ndarray, sets: list[tuple[WuManber, list[list[int]]]]) -> tuple[np.ndarray, list[set[int]]]:
    """Which words are hit, and the items met by each text."""
    bounds = np.r_[0, np.cumsum(counts)]
    edge, items = np.zeros(len(code) + 1, np.int64), [set() for _ in counts]
    for machine, owners in sets:
        for end, window in machine.matches(code, bounds):
            np.add.at(edge, end - machine.m + 1, 1)
            np.add.at(edge, end + 1, -1)
            text = np.searchsorted(bounds, end, side="right") - 1
            for pair in np.unique(text * len(owners) + window).tolist():
                items[pair // len(owners)].update(owners[pair % len(owners)])
    return np.cumsum(edge[:-1]) > 0, items


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _pass(docs: DataFrame, text: str, block: list[tuple], window: int) -> DataFrame:
    """Adds the block's hits to __n_words, __spans and __items."""
    own_ids: dict = {}
    number = [own_ids.setdefault(x, len(own_ids)) for x, _ in block]
    values = list(own_ids)
    built = Windows([x for _, x in block], window)
    known, sets = built.known, [(patterns, [sorted({number[x] for x in own}) for own in owners]) for patterns, owners in built.sets]

    def work(machines: list, piece: pa.RecordBatch) -> pa.RecordBatch:
        code, counts = word_codes(encoded(piece.column(text)), known)
        bounds = np.r_[0, np.cumsum(counts)]
        hit, items = _found(code.astype(np.int64), counts, machines)
        spans, met = piece.column("__spans").to_pylist(), piece.column("__items").to_pylist()
        for at in np.flatnonzero([bool(old or new) for old, new in zip(spans, items, strict=True)]).tolist():
            own = hit[bounds[at] : bounds[at + 1]]
            for x in spans[at]:
                own[x["a"] : x["b"]] = True
            spans[at] = [{"a": a, "b": b} for a, b in _spans(own)]
            met[at] += [v for v in (values[x] for x in sorted(items[at])) if v not in met[at]]
        new = {"__n_words": counts.astype(np.int64), "__spans": spans, "__items": met}
        return pa.RecordBatch.from_arrays(
            [pa.array(new[f.name], f.type) if f.name in new else piece.column(f.name) for f in piece.schema], names=piece.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = [(WuManber(patterns), owners) for patterns, owners in sets]
        for batch in batches:
            for piece in chunks(batch, text):
                yield work(machines, piece)

    return docs.mapInArrow(run, docs.schema)


def marked(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with __n_words, __spans (of words inside a window's occurrence, a to before b, merged) and __items (ids of those that
    occur); columns of these names are replaced."""
    told = item_words(items, item_id, item_text)
    kind = told.schema["item_id"].dataType.simpleString()
    found = docs.withColumns({
        "__n_words": F.lit(0).cast("bigint"), "__spans": F.expr("CAST(array() AS array<struct<a:bigint,b:bigint>>)"),
        "__items": F.expr(f"CAST(array() AS array<{kind}>)")})
    for block in _blocks_or_none(told):
        found = _pass(found, text, block, window)
    return found


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """doc_id, n_words, spans, items of every document, as `marked`."""
    found = marked(docs.select(doc_id, text), items, window, text, item_id, item_text)
    return found.select(F.col(doc_id).alias("doc_id"), F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"), F.col("__items").alias("items"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    return marked(docs, items, window, text, item_id, item_text).filter(F.size("__spans") == 0).select(*docs.columns)


def _blocks_or_none(told: DataFrame) -> Iterator[list[tuple]]:
    """The blocks; without any word one empty block, whose pass counts the words."""
    some = False
    for block in item_blocks(told):
        some = True
        yield block
    if not some:
        yield []
