"""Vectorized work on the bytes of Arrow text columns, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows: up to `limit` bytes, or one longer row."""
    data, offsets = bytes_of(column)
    rows, low = len(offsets) - 1, 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def runs(batch: pa.RecordBatch, column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with up to `limit` bytes of text each, or one longer row."""
    if not batch.num_rows:
        yield batch
    for low, high, _, _ in slices(batch.column(column), limit):
        yield batch.slice(low, high - low)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that close values come out unlike."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, count: int) -> np.ndarray:
    """base**i mod 2**64 for i below count."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        step = np.full(max(count, 1 << 20), base, U64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:count]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes wherever they stand."""
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=total[1:])
    own = (total[ends] - total[starts]) * powers(BASE_INVERSE, len(data) + 1)[starts]
    return mixed(own + (ends - starts).astype(U64))


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of the maximal runs of bytes marked in `inside` (256 flags) that stay in one row."""
    mark = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], mark[:-1]]) if len(mark) else mark
    starts = np.flatnonzero(mark & (~before | edge[:-1]))
    after = np.concatenate([mark[1:], [False]]) if len(mark) else mark
    ends = np.flatnonzero(mark & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of `words` words of a row; a row of fewer words has one, of all its words."""
    starts, ends, row = word_spans(data, offsets, ~SPACES)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    value = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    left = (first + count)[row] - np.arange(len(row))  # words from here to the end of the row
    out = np.zeros(len(row), U64)
    for j in range(words):
        here = np.zeros(len(row), U64)
        here[: len(row) - j] = value[j:]
        out += np.where(left > j, here * U64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)), U64(0))
    keep = (left >= words) | ((count[row] < words) & (left == count[row]))
    return row[keep], mixed(out[keep])
