r"""Chat formatting with a grammar that reads its own output.

    turn := "<s>" text "</s>"                                    of the assistant
          | "<s>" "[INST]" role "\n" text "[/INST]"              of anyone else

A conversation is its turns one after the other. The four control strings are the only ones that the parser acts on. A
backslash run after a control string's first character marks it as text: the parser takes one backslash away. A turn is
rendered with its text as it is, read back, and compared with its source; where they differ its control strings (and
those that carry backslashes) get one backslash more, until what is read back is identical. Every turn begins and ends
with a control string, so what the parser reads from a conversation is what it reads from its turns.

Null roles and texts are empty; a null conversation id is a conversation of its own; turns of one number (and null turns,
which come first) are in the order of role and text, repeated rows are repeated turns. Other columns don't take part.
A conversation of any length passes through a task row by row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alpenglow.llm.common import chunks

ASSISTANT = "assistant"
#: A control string, or one that backslashes mark as text.
CONTROL = re.compile(r"<(\\*)/?s>|\[(\\*)/?INST\]")
BATCH = 5000


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound what the loss counts (both -1: nothing)."""
    tokens = ((m.start(), m[0]) for m in CONTROL.finditer(formatted) if m[0][1] != "\\")
    turns, at = [], 0

    def need(wanted: str, where: int | None = None) -> int:
        place, token = next(tokens, (-1, ""))
        if token != wanted or where is not None and place != where:
            raise ValueError(f"{wanted} expected after {at} characters")
        return place

    while at < len(formatted):
        start = need("<s>", at) + 3
        if formatted.startswith("[INST]", start):
            need("[INST]", start)
            end = need("[/INST]")
            role, line, text = formatted[start + 6 : end].partition("\n")
            if not line:
                raise ValueError(f"no role after {start} characters")
            turns.append((_role_in(role), unescape(text), -1, -1))
            at = end + 7
        else:
            end = need("</s>")
            turns.append((ASSISTANT, unescape(formatted[start:end]), start, end))
            at = end + 4
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """The turn's rendering, the bounds of what the loss counts in it, and how often it was escaped."""
    content = text
    for rounds in range(3):
        out = f"<s>{content}</s>" if role == ASSISTANT else f"<s>[INST]{_role_out(role)}\n{content}[/INST]"
        try:
            read = parse(out)
        except ValueError:
            read = []
        if [x[:2] for x in read] == [(role, text)]:
            return out, *read[0][2:], rounds
        content = escape(content)
    raise AssertionError("a turn can't be read back")


def render(frame: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a turn: conv_id, turn, formatted, loss_start, loss_end (code points in formatted; -1: none), escapes, and
    role and text as orders of turns of one number. A conversation's text is its turns' `formatted`, in order."""
    frame = frame.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                         F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    added = [T.StructField("formatted", T.StringType(), False)] + [
        T.StructField(x, T.LongType(), False) for x in ("loss_start", "loss_end", "escapes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                made = [render_turn(a, b) for a, b in zip(piece.column("role").to_pylist(), piece.column("text").to_pylist(), strict=True)]
                columns = [pa.array([x[0] for x in made], pa.string()), *(pa.array([x[k] for x in made], pa.int64()) for k in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], names=[*piece.schema.names, *(x.name for x in added)])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, *added]))


class _Read:
    """What has been read back of one conversation."""

    def __init__(self, key):
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str) -> None:
        self.chars += len(formatted)
        for role, text, start, end in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if start >= 0:
                said = unescape(formatted[start:end])
                self.loss_chars += len(said)
                self.loss.update(said.encode())

    def row(self) -> tuple:
        return self.key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digest(turns: DataFrame) -> DataFrame:
    """One row a conversation, parsed from the rendered turns: their number, digests of all turns and of what the loss counts."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for key, formatted in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), strict=True):
                if now is None or now.key != key:
                    if now is not None:
                        rows.append(now.row())
                    now = _Read(key)
                now.add(formatted)
            if len(rows) >= BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows = []
        if now is not None:
            rows.append(now.row())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    placed = turns.select("conv_id", "turn", "role", "text", "formatted").repartition("conv_id")
    placed = placed.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted")
    return placed.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
