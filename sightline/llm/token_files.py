"""Token ids in compressed binary blocks, coded by adaptive context mixing and a range coder.

A block holds the ids of whole documents. Its ids are laid out in LANES equal stretches that are coded side by side, one id of
each stretch a step, so that a step is vector work; all stretches share the block's model. For every id the
model predicts: the id last seen after the same two ids (order 2), the id last seen after the same one
(order 1), and the frequencies of all ids so far (order 0). The three are mixed: the share of
the code range given to the two predicted ids follows how often such predictions, at the same length of their runs of
success, came true in this block; the rest of the range goes to the frequencies. A 64-bit range coder per stretch codes the
id. Models are updated after each step and start anew in every block. The block ends with a CRC-32 of its ids.

Block: magic, version, numbers of documents, ids, lanes and alphabet (little-endian 32-bit), the documents' lengths,
the lengths of the lanes' words, the words, the CRC-32.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.kernels import runs
from sightline.llm.tables import bounded_batches, stored
from sightline.llm.tokens import encoder, vocabulary_path

MAGIC = b"SLTB"
VERSION = 1
END = 2
BLOCK_TOKENS = 1 << 20
BLOCK_DOCUMENTS = 1 << 16  # so that blocks of very short documents stay small too
MOST_DISTINCT = 1 << 21  # the code range of a step holds a unit for each
LANES = 4096
SLOTS = 1 << 20
SCALE = 16  # bits of a step's probability
U32, U64 = np.uint32, np.uint64
LOW32 = U64(0xFFFFFFFF)
RUN_BITS = 3
RUNS = 1 << RUN_BITS


class Model:
    """Adaptive predictions shared by the lanes of one block."""

    def __init__(self, alphabet: int):
        self.alphabet = alphabet
        self.counts = np.zeros(alphabet, np.int64)
        # Predicted id and run in one number, id * RUNS + run: after two ids by their hash, and after one id.
        self.second = np.zeros(SLOTS, np.int32)
        self.first = np.zeros(alphabet + 1, np.int32)
        # By the runs of both orders and whether they agree: all cases, hits of order 2, hits of order 1 alone.
        self.cases = np.full((RUNS * RUNS * 2, 3), (4.0, 1.0, 1.0))
        self._refresh()

    def _refresh(self) -> None:
        # Every id keeps a share of the range of order 0; its bits leave at least half of them to the counts.
        total = self.counts.sum()
        room = (1 << max(SCALE, self.alphabet.bit_length() + 1)) - self.alphabet
        share = 1 + (self.counts * room // max(1, total) if total else np.full(self.alphabet, room // self.alphabet))
        self.until = np.zeros(self.alphabet + 1, U64)
        np.cumsum(share, out=self.until[1:])
        self.top = self.until[-1]

    def predict(self, one: np.ndarray, two: np.ndarray) -> None:
        self.one = one
        self.slot = ((one.astype(U32) * U32(0x9E3779B1)) ^ (two.astype(U32) * U32(0x85EBCA77))) >> U32(12)
        second, first = self.second[self.slot], self.first[one]
        self.p2, self.p1, self.r2, self.r1 = second >> RUN_BITS, first >> RUN_BITS, second & (RUNS - 1), first & (RUNS - 1)
        self.case = (self.r2 * RUNS + self.r1) * 2 + (self.p1 == self.p2)
        cases = self.cases
        # At least a sixteenth of the range stays with the frequencies.
        scaled = cases[:, 1:] / cases[:, :1] * ((1 << SCALE) * 15 // 16)
        share = np.maximum(1, scaled.astype(np.int64))
        self.a2, self.a1 = share[:, 0].astype(U64)[self.case], share.sum(1).astype(U64)[self.case]

    def holding(self, free: np.ndarray) -> np.ndarray:
        """The id whose share of the range of order 0 holds each unit."""
        if self.top > len(free) << 5:
            return np.searchsorted(self.until, free, "right") - 1
        return np.repeat(np.arange(self.alphabet), np.diff(self.until).astype(np.int64))[free.astype(np.int64)]

    def update(self, ids: np.ndarray) -> None:
        hit2, hit1 = ids == self.p2, ids == self.p1
        seen = np.bincount(self.case * 3 + np.where(hit2, 1, 2 * hit1), minlength=3 * len(self.cases)).reshape(-1, 3)
        self.cases[:, 0] += seen.sum(1)
        self.cases[:, 1:] += seen[:, 1:]
        self.counts += np.bincount(ids, minlength=self.alphabet)
        base = ids.astype(np.int32) << RUN_BITS
        self.second[self.slot] = base | np.where(hit2, np.minimum(self.r2 + 1, RUNS - 1), 0)
        self.first[self.one] = base | np.where(hit1, np.minimum(self.r1 + 1, RUNS - 1), 0)
        self._refresh()


def _moving(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lanes whose upper word is settled or whose range is short, which of these have a short range that crosses a word)."""
    same = (low ^ (low + span)) <= LOW32
    short = span <= LOW32
    move = np.flatnonzero(same | short)
    return move, short[move] & ~same[move]


def _rest(step: np.ndarray, left: np.ndarray, model: Model) -> np.ndarray:
    """Code range per unit of order-0 frequency."""
    return step * (U64(1 << SCALE) - left) // U64(model.top)


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[int, list[np.ndarray]]:
    """(lanes, code words of each lane) of the ids of one block."""
    lanes = max(1, min(LANES, len(ids) // 64))
    steps = -(-len(ids) // lanes)
    grid = np.zeros(lanes * steps, np.int64)
    grid[: len(ids)] = ids
    grid = grid.reshape(lanes, steps).T.copy()
    model = Model(alphabet)
    low, span = np.zeros(lanes, U64), np.full(lanes, U64(0xFFFFFFFFFFFFFFFF), U64)
    words = np.zeros((lanes, steps + 4), U32)
    at = np.zeros(lanes, np.int64)
    one = two = np.full(lanes, alphabet, np.int64)
    for t in range(steps):
        now = grid[t]
        model.predict(one, two)
        step = span >> U64(SCALE)
        end2, end1 = step * model.a2, step * model.a1
        hit2 = now == model.p2
        hit1 = ~hit2 & (now == model.p1)
        start, span = np.where(hit2, U64(0), end2), np.where(hit2, end2, end1 - end2)
        rest = np.flatnonzero(~(hit2 | hit1))
        unit, ids = _rest(step[rest], model.a1[rest], model), now[rest]
        start[rest] = end1[rest] + unit * model.until[ids]
        span[rest] = unit * (model.until[ids + 1] - model.until[ids])
        low += start
        move, cut = _moving(low, span)
        while len(move):
            own, width = low[move], span[move]
            width[cut] = (~own[cut] + U64(1)) & LOW32
            words[move, at[move]] = own >> U64(32)
            at[move] += 1
            low[move], span[move] = own, width = own << U64(32), width << U64(32)
            if at.max() + 2 >= words.shape[1]:
                words = np.concatenate([words, np.zeros_like(words)], 1)
            again, cut = _moving(own, width)
            move = move[again]
        model.update(now)
        one, two = now, one
    for shift in (32, 0):
        words[np.arange(lanes), at] = (low >> U64(shift)) & LOW32
        at += 1
    return lanes, [words[i, : at[i]] for i in range(lanes)]


def decode_ids(n: int, lanes: int, code: list[np.ndarray], alphabet: int) -> np.ndarray:
    steps = -(-n // lanes)
    longest = max(len(c) for c in code) + 4
    words = np.zeros((lanes, longest), U64)
    for i, c in enumerate(code):
        words[i, : len(c)] = c
    value = (words[:, 0] << U64(32)) | words[:, 1]
    at = np.full(lanes, 2)
    model = Model(alphabet)
    low, span = np.zeros(lanes, U64), np.full(lanes, U64(0xFFFFFFFFFFFFFFFF), U64)
    grid = np.zeros((steps, lanes), np.int64)
    one = two = np.full(lanes, alphabet, np.int64)
    for t in range(steps):
        model.predict(one, two)
        step = span >> U64(SCALE)
        end2, end1 = step * model.a2, step * model.a1
        within = value - low
        hit2 = within < end2
        now = np.where(hit2, model.p2, model.p1).astype(np.int64)
        start, span = np.where(hit2, U64(0), end2), np.where(hit2, end2, end1 - end2)
        rest = np.flatnonzero(within >= end1)
        unit = _rest(step[rest], model.a1[rest], model)
        free = np.minimum((within[rest] - end1[rest]) // unit, model.top - U64(1))
        ids = model.holding(free)
        now[rest] = ids
        start[rest] = end1[rest] + unit * model.until[ids]
        span[rest] = unit * (model.until[ids + 1] - model.until[ids])
        low += start
        move, cut = _moving(low, span)
        while len(move):
            own, width = low[move], span[move]
            width[cut] = (~own[cut] + U64(1)) & LOW32
            low[move], span[move] = own, width = own << U64(32), width << U64(32)
            value[move] = (value[move] << U64(32)) | words[move, np.minimum(at[move], longest - 1)]
            at[move] += 1
            again, cut = _moving(own, width)
            move = move[again]
        grid[t] = now
        model.update(now)
        one, two = now, one
    return grid.T.reshape(-1)[:n]


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids in order, rank of every id among them); small ids are counted instead of sorted."""
    if not len(ids) or ids.max() >= MOST_DISTINCT:
        return np.unique(ids, return_inverse=True)
    held = np.bincount(ids) > 0
    return np.flatnonzero(held), (np.cumsum(held) - 1)[ids]


def write_block(documents: list[np.ndarray]) -> bytes:
    """One block of the ids of whole documents."""
    ids = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64)
    # Ids are coded as their rank among the block's distinct ids, so that any 32-bit id fits and rare alphabets cost little.
    known, ranks = _ranked(ids)
    if len(known) > MOST_DISTINCT:
        raise ValueError(f"a block may hold at most {MOST_DISTINCT} distinct ids")
    lanes, code = encode_ids(ranks, max(1, len(known))) if len(ids) else (0, [])
    head = np.array([VERSION, len(documents), len(ids), lanes, len(known)], "<u4")
    lengths = np.array([len(d) for d in documents], "<u4")
    sizes = np.array([len(c) for c in code], "<u4")
    body = np.concatenate([*code, np.zeros(0, U32)]).astype("<u4")
    parts = [MAGIC, head.tobytes(), known.astype("<u4").tobytes(), lengths.tobytes(), sizes.tobytes(), body.tobytes()]
    return b"".join(parts) + zlib.crc32(ids.astype("<u4").tobytes()).to_bytes(4, "little")


def read_block(block: bytes) -> list[np.ndarray]:
    """The documents' ids (unsigned 32-bit) of one block; ValueError if it is damaged."""
    if block[:4] != MAGIC or len(block) < 28:
        raise ValueError("not a token block")
    version, n_docs, n, lanes, n_known = np.frombuffer(block, "<u4", 5, 4).tolist()
    if version != VERSION:
        raise ValueError(f"unknown version {version}")
    rest = np.frombuffer(block[24:-4], "<u4")
    known, lengths, sizes = rest[:n_known], rest[n_known : n_known + n_docs].astype(np.int64), rest[n_known + n_docs : n_known + n_docs + lanes].astype(np.int64)
    body = rest[n_known + n_docs + lanes :]
    if len(sizes) != lanes or len(body) != sizes.sum():
        raise ValueError("a token block is cut short")
    code = np.split(body, np.cumsum(sizes)[:-1]) if lanes else []
    ids = known[decode_ids(n, lanes, code, n_known)] if n else np.zeros(0, "<u4")
    if zlib.crc32(ids.astype("<u4").tobytes()).to_bytes(4, "little") != block[-4:]:
        raise ValueError("the checksum of a token block does not fit")
    return np.split(ids, np.cumsum(lengths)[:-1]) if n_docs else []


def write_token_files(docs: DataFrame, folder: str, end: int = END, path: str | None = None) -> None:
    """Encode every text and write blocks in ascending doc_id order.

    The files are Parquet rows (shard, block, doc_ids, ends, data): shards are ranges of doc_id, blocks follow each other in
    a shard, `ends` counts the block's ids up to the end of each document, and `data` is a block as described
    above. Null text counts as empty; a document longer than BLOCK_TOKENS has a block of its own. Null ids come first; repeated rows are documents of their own.
    """
    path = path or vocabulary_path()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codes, shard, number = encoder(path), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        tokens = 0

        def block() -> pa.RecordBatch:
            nonlocal number
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([np.cumsum([len(x) for x in held])], pa.list_(pa.int64())), pa.array([write_block(held)], pa.binary())],
                ["shard", "block", "doc_ids", "ends", "data"],
            )
            number += 1
            names.clear()
            held.clear()
            return out

        for batch in (piece for whole in batches for piece in runs(whole, "text")):
            every, ends = codes.encode_all(batch.column("text"))
            for doc_id, low, high in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                ids = every[low:high]
                if held and (tokens + len(ids) + 1 > BLOCK_TOKENS or len(held) >= BLOCK_DOCUMENTS):
                    yield block()
                    tokens = 0
                names.append(doc_id)
                held.append(np.append(ids, U32(end)))
                tokens += len(ids) + 1
        if held:
            yield block()

    bounded_batches(rows).mapInArrow(run, "shard int, block long, doc_ids array<long>, ends array<long>, data binary").write.parquet(folder)


def read_token_files(spark, folder: str) -> DataFrame:
    """(shard, block, doc_id, nth, ids) of every document in the files; ids are little-endian unsigned 32-bit integers. Damaged blocks fail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, names, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "doc_ids", "data"))):
                parts = [x.astype("<u4").tobytes() for x in read_block(data)]
                k = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * k, pa.int32()), pa.array([number] * k, pa.int64()), pa.array(names, pa.int64()), pa.array(range(k), pa.int64()), pa.array(parts, pa.binary())],
                    ["shard", "block", "doc_id", "nth", "ids"],
                )

    return spark.read.parquet(folder).mapInArrow(run, "shard int, block long, doc_id long, nth long, ids binary")


def token_offsets(spark, folder: str) -> DataFrame:
    """(shard, block, nth, start) of every document: ids of all documents before it, from the ends beside the blocks.

    Running sums are taken in three narrow steps (documents of a block, blocks of a shard, shards), so no task sees all documents.
    """
    rows = spark.read.parquet(folder).select("shard", "block", "ends", F.element_at("ends", -1).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.withColumn("in_shard", F.coalesce(F.sum("n").over(before), F.lit(0)))
    shards = rows.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = stored(shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at_shard")), "token-shards")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.slice("ends", F.lit(1), F.size("ends") - 1))
    blocks = blocks.join(shards, "shard").select("shard", "block", F.posexplode(starts).alias("nth", "own"), "in_shard", "at_shard")
    return blocks.select("shard", "block", F.col("nth").cast("long").alias("nth"), (F.col("own") + F.col("in_shard") + F.col("at_shard")).alias("start"))
