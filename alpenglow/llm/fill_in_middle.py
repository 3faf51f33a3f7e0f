"""Fill-in-middle texts by a secondary sort of pieces.

1. Every text becomes pieces of at most CHUNK units, keyed by its document and by the place in the output at which the piece
   begins; the sentinels go at the head of the piece they precede.
2. Pieces are partitioned by document and sorted within partitions by (document, place), which is what
   repartitionAndSortWithinPartitions does, on DataFrames. A task reads its pieces in order, feeds them to a digest and parses
   the output again: from the form and the sentinels alone it finds which part of the text each piece belongs to.
3. Restoration sorts the same partitions again, by (document, part, place), without another shuffle, and feeds the pieces to a
   second digest.

No step holds more than some pieces of a document, so the length of a text costs disk in the sorts and no memory.

The two cut points, the form and its share come from the sha256 of `seed:` and the id. Null texts are empty, and empty texts
are plain; a null id counts as the empty text. The key of a row is its id and a hash of id and text; rows that agree in both
travel as one with their number, and come back that many times. Texts that contain a sentinel stay plain, so that the parse is
unambiguous. Columns other than id and text take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
SEED = "1"
#: Of 100 texts: from this number on they stay plain; of the others, those below SPM begin with the suffix.
PLAIN_FROM, SPM = 90, 20
#: Units of a piece.
CHUNK = 4096
#: Output order of the parts by form, with the place of each in the text.
ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)), "plain": (("", 0),)}
END = 3  # sorts behind all parts
ROWS = 2000


def cut_points(text: str, unit: str | None) -> list[int] | range:
    """Ends of the units, from 0: code points, or the matches of a pattern from left to right (the last takes the rest)."""
    if unit is None:
        return range(len(text) + 1)
    return [0, *[x.end() for x in re.finditer(unit, text)][:-1], len(text)] if text else [0]


def plan(name: str, text: str, seed: str = SEED, unit: str | None = None) -> tuple[str, list[int] | range, int, int]:
    """Form, ends of the units, and after how many units the prefix and the middle end."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    ends = cut_points(text, unit)
    n = len(ends) - 1
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in SENTINELS) or h3 % 100 >= PLAIN_FROM:
        return "plain", ends, 0, n
    return ("spm" if h4 % 100 < SPM else "psm"), ends, first, last


def split(name: str, text: str, seed: str, unit: str | None, chunk: int) -> Iterator[tuple]:
    """(place, piece, n, form, prefix units, middle units); the last four on the first piece alone."""
    form, ends, first, last = plan(name, text, seed, unit)
    n = len(ends) - 1
    parts = ((0, first), (first, last), (last, n)) if form != "plain" else ((0, n),)
    about, place = (n, form, None, None) if form == "plain" else (n, form, first, last - first), 0
    for mark, part in ORDER[form]:
        a, z = parts[part]
        for at in range(a, max(z, a + 1), chunk):
            piece = mark + text[ends[at] : ends[min(at + chunk, z)]] if z > a else mark
            yield place, piece, *about
            place, mark, about = place + len(piece), "", (None,) * 4


class Parser:
    """Parts of an output that comes in pieces, found by its form and the sentinels."""

    def __init__(self, form: str):
        self.marks, self.rest, self.part = list(ORDER[form]), "", None
        if form == "plain":
            self.part, self.marks = 0, []

    def feed(self, piece: str, last: bool = False) -> Iterator[tuple[int, str]]:
        """(part, text) of what is certain so far: a sentinel may still be cut at the end."""
        self.rest += piece
        while self.marks and (at := self.rest.find(self.marks[0][0])) >= 0:
            mark, part = self.marks.pop(0)
            if at:
                yield self._here(), self.rest[:at]
            self.part, self.rest = part, self.rest[at + len(mark) :]
        keep = 0 if last or not self.marks else len(self.marks[0][0]) - 1
        ready = self.rest[: len(self.rest) - keep]
        if ready:
            yield self._here(), ready
            self.rest = self.rest[len(ready) :]
        if last and self.marks:
            raise ValueError(f"the output ends without {self.marks[0][0]}")

    def _here(self) -> int:
        if self.part is None:
            raise ValueError("the output has text before its first sentinel")
        return self.part


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded number and size; `text`: place of the long column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "")
        if len(held) >= ROWS or size >= 1_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*(x.to_pylist() for x in batch.slice(at, ROWS).columns), strict=True)


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of one document after the other; a group must be read before the next one."""
    row = next(rows, None)
    while row is not None:
        key, after = row[:2], []

        def group(first: tuple = row, key: tuple = key, after: list = after) -> Iterator[tuple]:
            now = first
            while now is not None and now[:2] == key:
                yield now
                now = next(rows, None)
            after.append(now)

        yield key, group()
        row = after[0]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED, unit: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """row, doc_id, place, piece, copies, n, form, prefix, middle: the output's pieces in any order."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), batch.schema.field(1), ("place", pa.int64()), ("piece", pa.string()), ("copies", pa.int64()),
                                ("n", pa.int64()), ("form", pa.string()), ("prefix", pa.int64()), ("middle", pa.int64())])
            for part in chunks(batch):
                copies: dict[tuple, int] = {}
                for key in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    copies[key] = copies.get(key, 0) + 1

                def cut(part: pa.RecordBatch = part, copies: dict = copies) -> Iterator[tuple]:
                    for row, own, name, value in _rows([part]):
                        count = copies.pop((row, own), 0)
                        if count:
                            for place, piece, n, *rest in split(name, value, seed, unit, chunk):
                                yield row, own, place, piece, count if n is not None else None, n, *rest

                yield from _batches(cut(), schema, 3)

    return docs.mapInArrow(run, f"row bigint, doc_id {kind}, place bigint, piece string, copies bigint, n bigint, form string, prefix bigint, middle bigint")


def _output(group: Iterator[tuple], take: Callable[[str], None], about: list) -> Iterator[str]:
    """The pieces of one document once each, in order; copies of the row are counted in about = [copies, n, form, prefix, middle]."""
    last = -1
    for _, _, place, piece, copies, *rest in group:
        if copies is not None:
            about[:] = [(about[0] if about else 0) + copies, *rest]
        if place != last:
            last = place
            take(piece)
            yield piece


def _sorted(cut: DataFrame) -> DataFrame:
    return cut.repartition("row").sortWithinPartitions("row", "doc_id", "place")


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED, unit: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n (units), form, prefix, middle (units; null: plain), output: the whole transformed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field("doc_id"), ("n", pa.int64()), ("form", pa.string()), ("prefix", pa.int64()), ("middle", pa.int64()), ("output", pa.string())])

        def joined() -> Iterator[tuple]:
            for (_, own), group in _groups(_rows(x for part in ([first], batches) for x in part)):
                about: list = []
                whole = "".join(_output(group, lambda piece: None, about))
                for _ in range(about[0]):
                    yield own, *about[1:], whole

        yield from _batches(joined(), schema, 5)

    cut = pieces(docs, doc_id, text, seed, unit, chunk)
    return _sorted(cut).mapInArrow(run, f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, n bigint, form string, prefix bigint, middle bigint, output string")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED, unit: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n, form, prefix, middle, output_sha256, restored_sha256 (of the text rebuilt from output and form)."""
    cut = pieces(docs, doc_id, text, seed, unit, chunk)
    kind = cut.schema["doc_id"].dataType.simpleString()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field("row"), first.schema.field("doc_id"), ("part", pa.int32()), ("place", pa.int64()), ("piece", pa.string()),
                            ("copies", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix", pa.int64()), ("middle", pa.int64())])

        def parsed() -> Iterator[tuple]:
            for key, group in _groups(_rows(x for part in ([first], batches) for x in part)):
                digest, about, parser, place = hashlib.sha256(), [], None, 0
                for piece in _output(group, lambda x, d=digest: d.update(x.encode()), about):
                    parser = parser or Parser(about[2])
                    for part, found in parser.feed(piece):
                        yield *key, part, place, found, *(None,) * 5
                        place += len(found)
                for part, found in parser.feed("", last=True):
                    yield *key, part, place, found, *(None,) * 5
                yield *key, END, 0, digest.hexdigest(), *about

        yield from _batches(parsed(), schema, 4)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field("doc_id"), ("n", pa.int64()), ("form", pa.string()), ("prefix", pa.int64()), ("middle", pa.int64()),
                            ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

        def rebuilt() -> Iterator[tuple]:
            for (_, own), group in _groups(_rows(x for part in ([first], batches) for x in part)):
                digest = hashlib.sha256()
                for _, _, part, _, piece, copies, *about in group:
                    if part != END:
                        digest.update(piece.encode())
                        continue
                    for _ in range(copies):
                        yield own, *about, piece, digest.hexdigest()

        yield from _batches(rebuilt(), schema, 5)

    assembled = _sorted(cut).mapInArrow(
        assemble, f"row bigint, doc_id {kind}, part int, place bigint, piece string, copies bigint, n bigint, form string, prefix bigint, middle bigint")
    return assembled.sortWithinPartitions("row", "doc_id", "part", "place").mapInArrow(
        restore, f"doc_id {kind}, n bigint, form string, prefix bigint, middle bigint, output_sha256 string, restored_sha256 string")
