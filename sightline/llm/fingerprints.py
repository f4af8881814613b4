"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a whole text; a chunk ends where the hash has enough zero bits. Chunking is
normalised: none ends before MIN_BYTES, a strict mask holds up to AVERAGE_BYTES and a loose one after it, and
MAX_BYTES ends a chunk in any case. Boundaries depend on the last 32 bytes only, so an insertion shifts
the chunks behind it but does not change them. The fingerprint is the set of chunk digests with their lengths, and
the likeness of two texts is the share of the first one's chunked bytes whose digests the second has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.kernels import runs, slices, span_hashes
from sightline.llm.tables import bounded_batches

MIN_BYTES, AVERAGE_BYTES, MAX_BYTES = 32, 64, 256
GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF0000000)  # seven and four bits of the hash's oldest end
NEVER = 1 << 40


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, end) of every chunk of every row, in order; empty rows have none."""
    size = len(data)
    rolled = GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        older = np.zeros_like(rolled)
        older[shift:] = rolled[:-shift] << np.uint32(shift)
        rolled = rolled + older
    strict = np.append(np.flatnonzero(rolled & STRICT == 0) + 1, NEVER)
    loose = np.append(np.flatnonzero(rolled & LOOSE == 0) + 1, NEVER)
    # All rows of the slice advance one chunk at a time, side by side.
    row = np.flatnonzero(np.diff(offsets) > 0)
    at, stop = offsets[row], offsets[row + 1]
    rows, ends = [], []
    while len(row):
        first = strict[np.searchsorted(strict, at + MIN_BYTES)]
        second = loose[np.searchsorted(loose, at + AVERAGE_BYTES)]
        end = np.where(first <= at + AVERAGE_BYTES, first, second)
        end = np.minimum(np.minimum(end, at + MAX_BYTES), stop)
        rows.append(row)
        ends.append(end)
        more = end < stop
        row, at, stop = row[more], end[more], stop[more]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, end = np.concatenate(rows), np.concatenate(ends)
    order = np.argsort(end, kind="stable")
    return row[order], end[order]


def digests(column: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct chunks as 64-bit values: 48 bits of digest above 16 bits of length."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(column)
    for low, high, data, offsets in slices(column, 1 << 19):
        row, end = chunk_ends(data, offsets)
        start = np.concatenate([[0], end[:-1]])
        value = (span_hashes(data, start, end) & ~np.uint64(0xFFFF)) | (end - start).astype(np.uint64)
        cut = np.searchsorted(row, np.arange(high - low + 1))
        for i in range(high - low):
            if cut[i] < cut[i + 1]:
                out[low + i] = np.unique(value[cut[i] : cut[i + 1]])
    return out


def written(chunks: np.ndarray) -> str:
    """A fingerprint as text: 16 hexadecimal digits a chunk, the last four its length, in rising order."""
    return chunks.astype(">u8").tobytes().hex()


def contained(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's bytes in chunks that b has too; an empty a is contained in an empty b only."""
    if not len(a):
        return float(not len(b))
    at = np.minimum(np.searchsorted(b, a), max(0, len(b) - 1))
    common = b[at] == a if len(b) else np.zeros(len(a), bool)
    weight = a & np.uint64(0xFFFF)
    return float(weight[common].sum() / weight.sum())


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with fingerprint, the chunk set of the text as a string; null text counts as empty, which has the empty string.

    Other columns and repeated rows are kept; a column named fingerprint is replaced.
    """
    kept = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([written(x) for x in digests(batch.column("text"))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, "fingerprint"])

    return bounded_batches(kept).mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("fingerprint", T.StringType())]))


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], list[int]]:
    """Upper ends of `parts` ranges of doc_id with about as many rows, and the largest id that occurs in each (both narrow)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    shares = [i / parts for i in range(1, parts)]
    ends = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or [])) if shares else []
    part = _part(F.col("doc_id"), ends)
    heads = [row[0] for row in ids.groupBy(part.alias("part")).agg(F.max("doc_id")).select(F.col("max(doc_id)")).collect()]
    return ends, sorted(heads)


def _part(doc_id, ends: list[int]):
    """Number of ends below the id, found in two steps over a square of ends."""
    if not ends:
        return F.lit(0)
    side = max(1, int(len(ends) ** 0.5))
    groups = [ends[i : i + side] for i in range(0, len(ends), side)]
    first = F.array(*[F.lit(g[-1]).cast("long") for g in groups])
    group = F.size(F.filter(first, lambda e: e < doc_id))
    own = F.array(*[F.array(*[F.lit(e).cast("long") for e in g]) for g in [*groups, [2**63 - 1]]])
    return (group * side + F.size(F.filter(F.get(own, group), lambda e: e < doc_id))).cast("int")


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one with the next smaller id, after the last the first; the edited text has its last third
    replaced by as many (or all) code points from the start of the next text. Rows are dealt by ranges of doc_id and streamed in
    falling order; the first row of each range is also sent to the range above, whose last row it follows.
    Null text counts as empty. Rows without an id count as below all others; of repeated ids the order is by text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends, heads = _ranges(docs, parts)
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(_part(F.col("doc_id"), ends) + 1)
    dealt = rows.withColumn("part", place).withColumn("own", F.lit(True))
    full = sorted({r[0] for r in dealt.select("part").distinct().collect()})
    if not full:
        return _neighbour_rows(dealt)
    # The range above each, and for the lowest the text that begins the order.
    above = {full[i]: full[i + 1] for i in range(len(full) - 1)} | {full[-1]: full[0]}
    step = F.coalesce(*[F.when(F.col("part") == p, F.lit(q)) for p, q in above.items()]) if len(above) <= 64 else F.create_map(*[F.lit(x) for pair in above.items() for x in pair])[F.col("part")]
    lead = dealt.filter(F.col("doc_id").isin(heads) | F.col("doc_id").isNull()) if 0 in full else dealt.filter(F.col("doc_id").isin(heads))
    lead = lead.groupBy("part", "doc_id").agg(F.max("text").alias("text"))
    lead = lead.select("doc_id", "text", step.alias("part"), F.lit(False).alias("own"))
    return _neighbour_rows(dealt.unionByName(lead).repartitionById(full[-1] + 1, F.col("part")))


def _neighbour_rows(dealt: DataFrame) -> DataFrame:
    ordered = dealt.sortWithinPartitions("part", F.col("own").desc(), F.col("doc_id").desc_nulls_last(), F.col("text").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in (run for whole in batches for run in runs(whole, "text")):
            texts = batch.column("text").to_pylist()
            chunks = digests(batch.column("text"))
            names, part, own = (batch.column(c).to_pylist() for c in ("doc_id", "part", "own"))
            edited, pairs = [], []
            for i in range(batch.num_rows):
                if last and last[4]:
                    text, third = last[1], len(last[1]) // 3
                    edited.append(text[: len(text) - third] + texts[i][:third])
                    pairs.append((last[0], text, last[2], chunks[i], texts[i], last[3] == part[i]))
                last = (names[i], texts[i], chunks[i], part[i], own[i])
            yield _measured(edited, pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return bounded_batches(ordered).mapInArrow(run, schema)


def _measured(edited: list[str], pairs: list[tuple]) -> pa.RecordBatch:
    new = digests(pa.array(edited, pa.large_string()))
    columns = [
        pa.array([p[0] for p in pairs], pa.int64()),
        pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([written(p[2]) for p in pairs], pa.string()),
        pa.array([written(x) for x in new], pa.string()),
        pa.array([contained(p[2], x) for p, x in zip(pairs, new)], pa.float64()),
        pa.array([contained(p[2], p[3]) for p in pairs], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
