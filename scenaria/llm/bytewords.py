"""Words of whole Arrow batches of texts, found in their UTF-8 bytes all at once.

A word is a run of ASCII digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII.  As every byte of a
character beyond ASCII is 0x80 or more, words can be cut in the bytes: no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Byte of a word, lower-cased; 0 where a byte parts words.
LETTER = np.zeros(256, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    LETTER[_b] = _b
LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)


class Words:
    """The words of some texts: ``data`` holds their bytes end to end, word i at ``at[i]`` to ``at[i + 1]``; text j
    has the words ``first[j]`` to ``first[j + 1]``."""

    def __init__(self, text: np.ndarray, bounds: np.ndarray):
        letters = LETTER[text]
        inside = letters != 0
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        full = bounds[:-1][bounds[1:] > bounds[:-1]]  # words do not go from one text into the next
        start[full] = inside[full]
        end[full[1:] - 1] = inside[full[1:] - 1]
        begin = np.flatnonzero(start)
        self.at = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(np.flatnonzero(end) + 1 - begin, out=self.at[1:])
        self.data = letters[inside]
        self.first = np.searchsorted(begin, bounds)

    def __len__(self) -> int:
        return len(self.at) - 1

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start of each, past each) of the runs of ``size`` consecutive words of a text, joined by a space."""
        n = len(self)
        spaced = np.full(len(self.data) + n, 0x20, np.uint8)
        sizes = np.diff(self.at)
        spaced[np.arange(len(self.data)) + np.repeat(np.arange(n), sizes)] = self.data
        begin, past = self.at[:-1] + np.arange(n), self.at[1:] + np.arange(n)
        i = self.run_starts(size)
        return spaced, begin[i], past[i + size - 1]

    def run_starts(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words, text by text."""
        room = np.maximum(np.diff(self.first) - size + 1, 0)
        return np.arange(room.sum()) + np.repeat(self.first[:-1] - (np.cumsum(room) - room), room)

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """(number of every word, the distinct words by number)."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], pa.binary())
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(self.at), pa.py_buffer(self.data)])
        coded = column.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.binary())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, bounds of each); a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, size: int) -> Iterator[tuple[int, int, Words]]:
    """(first row, row past the last, their words) of consecutive texts of about ``size`` bytes together; a longer
    text is a slice of its own."""
    text, bounds = text_bytes(column)
    at, n = 0, len(bounds) - 1
    while at < n:
        past = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
        yield at, past, Words(text[bounds[at]:bounds[past]], bounds[at:past + 1] - bounds[at])
        at = past
