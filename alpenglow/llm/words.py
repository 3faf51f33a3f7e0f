"""Words of texts as codes: runs of letters, digits and non-ASCII characters, A-Z in lower case."""

from __future__ import annotations

from itertools import repeat

import numpy as np

#: A-Z in lower case; digits, a-z and the bytes of other characters as they are; a space for the rest.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes whose words are held as objects at a time.
SLICE_BYTES = 2_000_000


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_codes(texts: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The code of every word of the texts, in order (0: not known), and how many words each text has."""
    data = b" ".join([*texts, b""]).translate(WORD_BYTES)  # every text ends with a space
    space = np.frombuffer(data, np.uint8) == 32
    begins = np.flatnonzero(~space & np.r_[True, space[:-1]][: len(space)])
    ends = np.cumsum([len(x) + 1 for x in texts])
    counts = np.diff(np.searchsorted(begins, ends), prepend=0)
    codes, at = [np.zeros(0, np.int32)], 0
    while at < len(data):
        stop = data.find(b" ", min(at + SLICE_BYTES, len(data)) - 1) + 1
        found = data[at:stop].split()
        codes.append(np.fromiter(map(known.get, found, repeat(0)), np.int32, len(found)))
        at = stop
    return np.concatenate(codes), counts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + lengths, lengths)
