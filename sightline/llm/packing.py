"""Packing documents into sequences by best-fit decreasing.

Documents are tokenized and cut into full windows plus a rest; full windows are sequences of their own. The
rests of a run of documents are placed from the longest to the shortest, each into the open window with the least
room that still holds it. A segment tree over remaining room finds that window in logarithmic time. A task packs
its rows in runs of RUN_TOKENS ids or RUN_RESTS rests, so its memory is bounded and no document leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.kernels import runs
from sightline.llm.tables import bounded_batches
from sightline.llm.tokens import encoder, vocabulary_path

WINDOW = 1024
END = 0
RUN_TOKENS, RUN_RESTS = 1 << 23, 1 << 18


class OpenWindows:
    """Open windows by remaining room 0..window, as a segment tree that counts them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, name: int) -> None:
        self.at.setdefault(room, []).append(name)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, room) of an open window with the least room of at least `need`."""
        node = self.leaves + need
        if not self.count[node]:
            while node & 1 or not self.count[node ^ 1]:
                node >>= 1
                if node <= 1:
                    return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        self._add(room, -1)
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset) of each length (1 to window); equal lengths in their given order."""
    places, open_windows, n = [(0, 0)] * len(lengths), OpenWindows(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_windows.take(lengths[i])
        if found is None:
            found, n = (n, window), n + 1
        name, room = found
        places[i] = (name, window - room)
        open_windows.put(room - lengths[i], name)
    return places


def pack(docs: DataFrame, window: int = WINDOW, end: int = END, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece of a document.

    ids are little-endian unsigned 32-bit integers; every document ends with the id `end`, so a null or empty text is a piece
    of one id. Pieces of a sequence stand at offsets without gaps from 0. Each row of docs is a document of its own, repeated
    rows and null ids too. Sequence ids are those of the task's partition and number within it; an empty table gives no row.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part, sequence = encoder(path), TaskContext.get().partitionId() << 36, 0
        rest: list[tuple] = []
        tail = np.array([end], "<u4").tobytes()

        def packed() -> list[tuple]:
            nonlocal sequence
            places = best_fit_decreasing([len(x[2]) // 4 for x in rest], window)
            out = [(i, start, len(ids) // 4, ids, n, part + sequence + name, offset) for (i, start, ids, n), (name, offset) in zip(rest, places)]
            sequence += 1 + max((name for name, _ in places), default=-1)
            rest.clear()
            return out

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        held = 0
        for batch in (piece for whole in batches for piece in runs(whole, "text")):
            out: list[tuple] = []
            every, ends = codes.encode_all(batch.column("text"))
            for doc_id, low, high in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                ids = every[low:high].tobytes() + tail
                n = len(ids) // 4
                for start in range(0, n - window + 1, window):
                    out.append((doc_id, start, window, ids[4 * start : 4 * (start + window)], n, part + sequence, 0))
                    sequence += 1
                if n % window:
                    rest.append((doc_id, n - n % window, ids[4 * (n - n % window) :], n))
                    held += n % window
                if held >= RUN_TOKENS or len(rest) >= RUN_RESTS:
                    out += packed()
                    held = 0
            yield table(out)
        yield table(packed())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return bounded_batches(rows).mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
