"""Words of whole texts as 64-bit hashes, with their places, over Arrow text columns.

A word is a maximal run of A-Z, a-z, 0-9 and characters beyond ASCII, with A-Z in lower case. Two different words share a hash
with a chance of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sightline.llm.kernels import bytes_of, span_hashes, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _word_end(data: np.ndarray, at: int, stop: int) -> int:
    """First byte from `at` on that is outside words, or stop."""
    while at < stop:
        outside = np.flatnonzero(~INSIDE[data[at : min(at + 4096, stop)]])
        if len(outside):
            return at + int(outside[0])
        at += 4096
    return stop


def _pieces(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole rows of up to `limit` bytes; a longer row comes in pieces cut between words."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        at, stop = int(offsets[low]), int(offsets[low + 1])
        if stop - at > limit:
            while at < stop:
                end = _word_end(data, min(at + limit, stop), stop)
                yield low, data[at:end], np.array([0, end - at])
                at = end
            low += 1
        else:
            high = max(low + 1, int(np.searchsorted(offsets, at + limit, "right")) - 1)
            yield low, data[at : offsets[high]], offsets[low : high + 1] - at
            low = high


def hashed_words(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, hash) of the words of a column, in order; places count the words of a row from 0. Null counts as empty.

    Texts come in pieces of about `limit` bytes, so that the arrays stay small however long a text is.
    """
    data, offsets = bytes_of(column)
    row_before, words_before = -1, 0
    for low, part, own in _pieces(data, offsets, limit):
        part = LOWER[part]
        starts, ends, row = word_spans(part, own, INSIDE)
        count = np.bincount(row, minlength=len(own) - 1)
        place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        if low == row_before:
            place += words_before
        else:
            words_before = 0
        row_before, words_before = low + len(own) - 2, (words_before if len(own) == 2 else 0) + int(count[-1])
        yield row + low, place, span_hashes(part, starts, ends)


def hashes_of(words: list[str]) -> np.ndarray:
    """The hash of each given word (already in lower case)."""
    out = np.zeros(len(words), np.uint64)
    for row, _, value in hashed_words(pa.array(words, pa.large_string())):
        out[row] = value
    return out


class Vocabulary:
    """Numbers of known words by their hash."""

    def __init__(self, words: list[str]):
        value = hashes_of(words)
        self.order = np.argsort(value)
        self.sorted = value[self.order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash's word, -1 for words that are not known."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)
