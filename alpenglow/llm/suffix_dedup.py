"""Repeated passages by suffix order: bytes covered by a LENGTH-byte string that starts anywhere else.

1. Candidates. Each LENGTH-byte window has an anchor, the smallest hash of its GRAM-byte substrings, so equal windows have
   equal anchors at equal places. Consecutive windows with one anchor, cut into SLOTS by the anchor's place, are a run;
   all its windows share a core of bytes whose hash is the run's cell. Equal windows are always in runs of one cell, so
   runs whose cell occurs once are dropped by a count.
2. Equal runs. Runs with the same bytes are counted; if there are several, all their windows repeat, and of all of them one
   stands in what follows. Copies of a passage, whether two or a third of all rows, end here.
3. Suffix order. The different runs of a cell meet in a task (sorted by cell, 200 KB at a time). Windows whose hash no other
   window of the cell has cannot repeat and are left out; the suffixes of what is left are put in order by the difference cover algorithm (sort sampled triples, recurse on names, merge the
   rest), and the first LENGTH bytes of adjacent suffixes are compared. Windows of equal prefixes repeat.
   A cell with more than MOST different runs is not given to one task: its windows are exploded, grouped by digest and
   counted instead.
4. Repeated windows become spans; a document's spans are merged.

Strings of a second, smaller length are found in the same pass: runs are of windows of that length, a run's text reaches as far
as the longer windows that begin in it, so the same order and the same copies tell both. `report` counts with it the bytes of
passages that repeat from PASSAGE bytes on, beside those that LENGTH removes.

Matches are found on the texts as given (UTF-8 bytes, null: empty) and never cross documents. Rows that agree in id and
text are different documents, each a copy of the other. Documents shorter than LENGTH have no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks, encoded, joined, partitions, written
from alpenglow.llm.difference_cover import ranks
from alpenglow.llm.words import ranges

LENGTH = 400
#: Passages of fifty words have about 250 to 350 bytes, so they are counted from this length on.
PASSAGE = 200
GRAM = 64
SLOTS = 3
#: Slots of the runs that tell two lengths: their windows are short, so an anchor has few of them.
NESTED_SLOTS = 1
#: Different runs of a cell that one task orders; beyond, windows are grouped by digest.
MOST = 3000
#: Text whose windows are looked at, and text put in order, at once: numpy holds some hundred times as much beside it, in
#: arrays that should fit a core's cache.
LOOK_BYTES, SORT_BYTES = 100_000, 200_000
_BASE = 0xD1342543DE82EF95


def _gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` bytes (a power of two) at each position."""
    h, size = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    while size < gram:
        h = h[:-size] * np.uint64(pow(_BASE, size, 2**64)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def runs(texts: list[bytes], length: int, gram: int, slots: int, reach: int) -> tuple[np.ndarray, ...]:
    """text, cell, hash, start, number of windows, and missing bytes of every run of the texts.

    The text of a run reaches `reach` bytes from its last window's start on; what the document lacks of it is missing.
    """
    data, bounds = joined(texts)
    empty = tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return empty
    width = length - gram + 1
    places = np.arange(len(data) - gram + 1, dtype=np.uint64)
    shift = np.uint64(max(1, int(len(data)).bit_length()))
    hashes = _gram_hashes(data, gram)
    least = _sliding_min((hashes >> shift << shift) | places, width)  # ties: the leftmost
    del hashes
    window = np.arange(len(least))
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    inside = text[: len(least)] == text[length - 1 :]
    window, anchor = window[inside], (least[inside] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    if not len(window):
        return empty
    step = -(-width // slots)
    slot = (anchor - window) // step
    head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1]) | (np.diff(window) != 1)])
    start, n = window[head], np.diff(np.r_[head, len(window)])
    anchor, slot = anchor[head], slot[head]
    core_from, core_to = anchor - slot * step, anchor - (slot + 1) * step + 1 + length
    raw = memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    cell = np.array([digest(raw[a:b], s) for a, b, s in zip(core_from.tolist(), core_to.tolist(), slot.tolist(), strict=True)], np.uint64)
    stop = np.minimum(start + n - 1 + reach, bounds[text[start] + 1])
    own = np.array([digest(raw[a:b], o) for a, b, o in zip(start.tolist(), stop.tolist(), ((anchor - start) * width + n).tolist(), strict=True)], np.uint64)
    return text[start], cell, own, start - bounds[text[start]], n, start + n - 1 + reach - stop


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, row: a hash that tells rows apart which differ in id or text."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def _occurrences(docs: DataFrame, length: int, gram: int, slots: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, limit=LOOK_BYTES):
                at, cell, own, start, n, missing = runs(encoded(piece.column("text")), length, gram, slots, reach)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row").take(at), piece.column("doc_id").take(at), pa.array(cell.view(np.int64)), pa.array(own.view(np.int64)),
                     pa.array(start), pa.array(n.astype(np.int32)), pa.array(missing.astype(np.int32))],
                    names=["row", "doc_id", "cell", "run", "start", "n", "missing"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row bigint, doc_id {kind}, cell bigint, run bigint, start bigint, n int, missing int")


def _met(data: np.ndarray, cell: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Whether the hash of the `length` bytes at a place occurs at another place of its cell: so it does where the bytes do."""
    size = 1 << (length.bit_length() - 1)
    if not len(place):
        return np.zeros(0, bool)
    hashes = _gram_hashes(data, size)
    key = hashes[place] * np.uint64(_BASE) + hashes[place + length - size] + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    met = np.zeros(len(place), bool)
    met[order[same]] = True
    met[order[same + 1]] = True
    return met


def repeated_windows(texts: list[bytes], cells: np.ndarray, counts: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """For each of the ascending lengths, whether as many bytes from a place on also begin in another among texts of its cell.

    Text k has counts[k] places, its first ones, at each of which it has the smallest length at least. Only places whose hash
    is met again are put in order, with the part of their text that they need.
    """
    whole, bounds = joined(texts)
    text = np.repeat(np.arange(len(texts)), counts)
    cell = np.unique(cells, return_inverse=True)[1][text]
    place = ranges(bounds[:-1], counts)
    room = bounds[text + 1] - place
    need = np.zeros(len(place), np.int64)
    for shorter, length in zip([0, *lengths], lengths, strict=False):
        at = np.flatnonzero((room >= length) & (need == shorter))
        need[at[_met(whole, cell[at], place[at], length)]] = length
    kept = np.flatnonzero(need)
    flags = [np.zeros(len(place), bool) for _ in lengths]
    if not len(kept):
        return flags
    text, cell, place, need = text[kept], cell[kept], place[kept], need[kept]
    head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    begins, stops = place[head], np.maximum.reduceat(place + need, head)
    pad, raw = b"\0" * 8, memoryview(whole)
    data = np.frombuffer(pad.join([*(raw[a:b] for a, b in zip(begins.tolist(), stops.tolist(), strict=True)), b""]), np.uint8)
    ends = np.cumsum(stops - begins + 8)
    symbols = data.astype(np.int64) + 1
    symbols[(ends[:, None] - np.arange(8, 0, -1)).ravel()] = 0
    rank = ranks(symbols, lengths[-1])
    start = place + np.repeat(ends - 8 - stops, np.diff(np.r_[head, len(text)]))
    order = np.lexsort((rank[start], cell))
    place, need, cell = start[order], need[order], cell[order]
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words[: len(data) - 7]).view("<u8").ravel()
    same, done = np.flatnonzero(cell[1:] == cell[:-1]), 0
    for flag, length in zip(flags, lengths, strict=True):
        same = same[(need[same] >= length) & (need[same + 1] >= length)]
        for offset in [*range(done, length - 7, 8), length - 8]:  # adjacent prefixes, dropped at the first difference
            same = same[words[place[same] + offset] == words[place[same + 1] + offset]]
        done = length
        flag[kept[order[same]]] = True
        flag[kept[order[same + 1]]] = True
    return flags


def _stretches(batch: pa.RecordBatch, flag: np.ndarray, counts: np.ndarray, length: int) -> pa.RecordBatch:
    """The flagged windows of each run as spans (row, doc_id, a, b, size)."""
    first = np.cumsum(counts) - counts
    before, after = np.r_[False, flag[:-1]], np.r_[flag[1:], False]
    before[first] = False
    after[first + counts - 1] = False
    begins, ends = np.flatnonzero(flag & ~before), np.flatnonzero(flag & ~after)
    run = np.searchsorted(first, begins, side="right") - 1
    start = np.asarray(batch.column("start"))[run] - first[run]
    at = pa.array(run)
    return pa.RecordBatch.from_arrays(
        [batch.column("row").take(at), batch.column("doc_id").take(at), pa.array(start + begins), pa.array(start + ends + length),
         pa.array(np.full(len(run), length, np.int32))], names=["row", "doc_id", "a", "b", "size"])


def _spans(batch: pa.RecordBatch, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated windows of some cells' runs, each of the largest length that repeats; copies give none."""
    counts = np.asarray(batch.column("n"), dtype=np.int64)
    flags = repeated_windows(batch.column("bytes").to_pylist(), np.asarray(batch.column("cell")), counts, lengths)
    left = np.repeat(np.asarray(batch.column("copies")) == 1, counts)
    for flag, length in zip(flags[::-1], lengths[::-1], strict=True):
        yield _stretches(batch, flag & left, counts, length)
        left &= ~flag


def _by_cells(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell in pieces of about `size` bytes that end where a cell does."""
    held: list[pa.RecordBatch] = []
    full, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.asarray(batch.column("cell"))
        total = np.cumsum(np.asarray(pc.binary_length(batch.column("bytes")), dtype=np.int64))
        borders = np.flatnonzero(np.r_[last is not None and last != cells[0], cells[1:] != cells[:-1]])
        at = 0
        while True:
            # the first border from which on the piece is large enough
            done = total[at - 1] if at else 0
            enough = int(np.searchsorted(total, done + size - full, side="left")) + 1 if full < size else at
            border = int(np.searchsorted(borders, enough))
            if border == len(borders):
                break
            cut = int(borders[border])
            held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, full, at = [], 0, cut
        held.append(batch.slice(at))
        full += int(total[-1] - (total[at - 1] if at else 0))
        last = cells[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _ordered(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Spans (row, doc_id, a, b, size) of the repeated windows of runs that meet in a cell."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _by_cells(batches, SORT_BYTES):
            yield from _spans(piece, lengths)

    n = partitions(rows.sparkSession)
    return rows.repartition(n, "cell").sortWithinPartitions("cell").mapInArrow(run, f"row bigint, doc_id {kind}, a bigint, b bigint, size int")


def _with_hot(rows: DataFrame, small: DataFrame, on: list[str], size: str) -> DataFrame:
    """rows joined to `small` on some keys, of each of which `size` says how many rows it has.

    Keys with more than a share of all rows (one of four a partition, so no more keys than that) are cut into parts on both
    sides, so no task gets a whole hot one. These few keys are all that every task is given.
    """
    total = small.agg(F.sum(size)).first()[0] or 0
    share = max(1, total // (4 * partitions(rows.sparkSession)))
    parts = F.ceil(F.col(size) / share).cast("int")
    hot = small.filter(F.col(size) > share).select(*on, parts.alias("__parts"))
    rows = rows.join(F.broadcast(hot), on, "left")
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("row", "start"), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    small = small.withColumn("__part", F.explode(F.sequence(F.lit(0), F.when(F.col(size) > share, parts).otherwise(1) - 1)))
    return rows.join(small.drop(size), [*on, "__part"]).drop("__part")


def merged_spans(spans: DataFrame) -> DataFrame:
    """Spans (of one size, if they have any) that overlap or touch become one: no more of them than runs of removed bytes."""
    sizes = [x for x in spans.columns if x == "size"]
    size = F.col("size") if sizes else F.lit(0)
    in_text = Window.partitionBy("row", "doc_id").orderBy(*sizes, "a", "b")
    reached = F.max(F.struct(size.alias("size"), "b")).over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (reached["size"] < size) | (F.col("a") > reached["b"]), 1).otherwise(0)
    numbered = spans.withColumn("__begins", begins).withColumn("__run", F.sum("__begins").over(in_text))
    return numbered.groupBy("row", "doc_id", *sizes, "__run").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("__run")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, slots: int | None = None, passage: int | None = None) -> DataFrame:
    """row, doc_id, a, b: byte spans (a to before b) of keyed documents that `length` removes; spans may overlap.

    With `passage`, a smaller length, a further column `size` is `length` for those and `passage` for spans whose strings of
    that length repeat; bytes that `length` covers need not be in spans of `passage` again.
    """
    lengths = [length] if passage is None else [passage, length]
    least = lengths[0]
    found = _occurrences(docs, least, gram, slots or (SLOTS if passage is None else NESTED_SLOTS), length)
    again = written(found.groupBy("cell").agg(F.count("*").alias("in_cell")).filter("in_cell > 1"))
    found = written(_with_hot(found, again, ["cell"], "in_cell"))  # the rest works on the few runs whose cell occurs again
    kinds = written(found.groupBy("cell", "run").agg(
        F.count("*").alias("copies"), F.min(F.struct("row", "doc_id", "start")).alias("one"), F.max("n").alias("n"), F.max("missing").alias("missing")))
    extent = F.col("n") - 1 + length - F.col("missing")
    copied = _with_hot(found, kinds.filter("copies > 1").select("cell", "run", "copies"), ["cell", "run"], "copies")
    whole = extent >= length  # all its places of `length` bytes repeat, up to the end of its text
    copied = copied.select(
        "row", "doc_id", F.col("start").alias("a"), (F.col("start") + F.when(whole, extent).otherwise(F.col("n") - 1 + least)).alias("b"),
        F.when(whole, length).otherwise(least).alias("size"))
    several = kinds.groupBy("cell").agg(F.count("*").alias("kinds"), F.min("copies").alias("least")).filter("kinds > 1 AND least = 1")
    ones = kinds.join(several.select("cell", "kinds"), "cell").select("cell", "copies", "n", extent.alias("extent"), "kinds", "one.*")
    # the columns in the order of the keyed documents, so that their shuffle serves both this join and that with the spans
    texts = docs.select(F.col("doc_id").alias("text_id"), "text", F.col("row").alias("text_row"))
    ones = ones.join(texts, (F.col("row") == F.col("text_row")) & F.col("doc_id").eqNullSafe(F.col("text_id")))
    ones = ones.select("cell", "copies", "n", "kinds", "row", "doc_id", "start", F.substring(
        F.col("text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("extent")).alias("bytes"))
    ordered = _ordered(ones.filter(F.col("kinds") <= MOST).drop("kinds"), lengths)
    windows = ones.filter(F.col("kinds") > MOST).select("row", "doc_id", "start", "copies", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    windows = windows.withColumn("size", F.explode(F.array(*map(F.lit, lengths)))).filter(F.col("k") + F.col("size") <= F.octet_length("bytes"))
    windows = windows.select("row", "doc_id", "copies", (F.col("start") + F.col("k")).alias("a"), "size", F.sha2(F.substring("bytes", F.col("k") + 1, F.col("size")), 256).alias("digest"))
    twice = windows.groupBy("digest").agg(F.count("*").alias("__n")).filter("__n > 1").select("digest")
    digested = windows.filter("copies = 1").join(twice, "digest").select("row", "doc_id", "a", (F.col("a") + F.col("size")).alias("b"), "size")
    spans = copied.unionByName(ordered).unionByName(digested)
    return spans.drop("size") if passage is None else spans


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, how many bytes went, and in how many maximal runs."""
    kept, at, gone, pieces = [], 0, 0, 0
    end = -1
    for a, b in sorted(spans):
        if a > end:
            pieces += 1
            kept.append(text[at:a])
            gone += b - a
            end = b
        elif b > end:
            gone += b - end
            end = b
        at = end
    kept.append(text[at:])
    return b"".join(kept), gone, pieces


def with_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", row: str = "row") -> DataFrame:
    """The rows of docs with their spans as an array column __spans (null: none)."""
    spans = merged_spans(spans).groupBy("row", "doc_id").agg(F.collect_list(F.struct("a", "b", *(x for x in spans.columns if x == "size"))).alias("__spans"))
    spans = spans.select(F.col("row").alias("__span_row"), F.col("doc_id").alias("__span_id"), "__spans")
    on = (F.col(row) == F.col("__span_row")) & F.col(doc_id).eqNullSafe(F.col("__span_id"))
    return docs.join(spans, on, "left").drop("__span_row", "__span_id")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (as `remove` leaves it) and n_repeated of every document.

    n_repeated counts the bytes covered by a string of `passage` bytes, fewer than `length`, that also starts anywhere else.
    """
    keys = keyed(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                texts, spans = encoded(piece.column("text")), [x or [] for x in piece.column("__spans").to_pylist()]
                done = [cut(x, [(s["a"], s["b"]) for s in found if s["size"] == length]) for x, found in zip(texts, spans, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                     pa.array([x[2] for x in done], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in done]),
                     pa.array([x[0].decode(errors="ignore") for x in done], pa.string()),
                     pa.array([cut(x, [(s["a"], s["b"]) for s in found])[1] for x, found in zip(texts, spans, strict=True)], pa.int64())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "n_repeated"])

    kind = keys.schema["doc_id"].dataType.simpleString()
    return with_spans(keys, repeated_spans(keys, length, passage=passage)).select("doc_id", "text", "__spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string, n_repeated bigint")


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows with repeated bytes taken out of their texts; a character of which a part was taken goes, null stays null."""
    names = docs.columns
    keys = keyed(docs, doc_id, text)
    marked = docs.withColumn("__row", F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))))
    marked = with_spans(marked, repeated_spans(keys, length), doc_id, "__row").drop("__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                values = piece.column(text).to_pylist()
                done = [x if not spans else cut(x.encode(), [(s["a"], s["b"]) for s in spans])[0].decode(errors="ignore")
                        for x, spans in zip(values, piece.column("__spans").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.string()) if n == text else piece.column(n) for n in names], names=names)

    return marked.mapInArrow(run, docs.schema)
