"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

Elements are the five-word shingles of a text. Every element owns a fixed, hashed set of darts: its
half-plane weight x rank is cut into cells of area one, a cell holds a Poisson(1) number of darts, and each
dart has a weight, a rank and one of `COORDINATES` coordinates. A document keeps the darts below its
elements' weights; the earliest dart of a coordinate is its signature value there, so two documents
agree on a coordinate with probability of their weighted Jaccard similarity. Darts are thrown
up to a rank that fills all coordinates with high probability, and further for the few documents with a gap.

Bands of the signature are joined. In each bucket all members are first compared with one hub (a star, not all pairs);
buckets that still hold several classes are compared in blocks, where only links that join classes leave the task.
Every link is verified by the exact similarity of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.graph import components
from sightline.llm.kernels import mixed, shingles, slices
from sightline.llm.tables import bounded_batches, packed, stored

WORDS = 5
SIMILARITY = 0.8
ROWS, BANDS = 7, 36
COORDINATES = ROWS * BANDS
BLOCK_ELEMENTS = 400_000
U64 = np.uint64


def _poisson_steps() -> np.ndarray:
    """Upper limits of a uniform 32-bit value for 0, 1, 2, ... darts of a Poisson(1) cell."""
    mass, total, out, j = np.exp(-1.0), 0.0, [], 0
    while total < 1 - 1e-10:
        total += mass
        out.append(total)
        j += 1
        mass /= j
    return np.array(out) * 2.0**32


POISSON = _poisson_steps()


def _darts(row: np.ndarray, element: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, coordinate, rank, dart) of the kept darts with a rank in [low, high) of each element.

    Weights are cut into bands [0, 1), [1, 2), [2, 4), ...; in a band of width b a cell covers 1/b of rank.
    """
    found = []
    band, floor, width = 0, 0.0, 1.0
    alive = np.arange(len(element))
    while len(alive := alive[weight[alive] > floor]):
        first = np.floor(low[alive] * width).astype(np.int64)
        cells = np.ceil(high[alive] * width).astype(np.int64) - first
        at = np.repeat(alive, cells)
        cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells) + np.repeat(first, cells)
        place = mixed(element[at] + mixed(cell.astype(U64) * U64(64) + U64(band + 1)))
        count = np.searchsorted(POISSON, (place >> U64(32)).astype(np.float64), "right")
        at, cell, place = np.repeat(at, count), np.repeat(cell, count), np.repeat(place, count)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        dart = mixed(place + U64(0x9E3779B97F4A7C15) * (nth.astype(U64) + U64(1)))
        rank = (cell + (dart >> U64(11)).astype(np.float64) * 2.0**-53) / width
        other = mixed(dart)
        height = floor + width * (other >> U64(32)).astype(np.float64) * 2.0**-32
        coordinate = ((other & U64(0xFFFFFFFF)) * U64(COORDINATES)) >> U64(32)
        keep = (height < weight[at]) & (rank >= low[at]) & (rank < high[at])
        found.append((row[at[keep]], coordinate[keep].astype(np.int64), rank[keep], dart[keep]))
        band, floor, width = band + 1, 2.0**band, 2.0**band
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*found))


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, full): the dart of each row and coordinate; rows without positive weight are not full.

    A repeated element throws the same darts, so sets need not be made distinct first.
    """
    total = np.bincount(row, weight, rows)
    best, value = np.full(rows * COORDINATES, np.inf), np.zeros(rows * COORDINATES, U64)
    low = np.zeros(rows)
    with np.errstate(divide="ignore"):
        step = np.where(total > 0, COORDINATES * (np.log(COORDINATES) + 3) / total, 0)
    high, open_rows = step.copy(), total > 0
    while open_rows.any():
        use = open_rows[row]
        at, coordinate, rank, dart = _darts(row[use], element[use], weight[use], low[row[use]], high[row[use]])
        slot = at * COORDINATES + coordinate
        order = np.lexsort((dart, rank, slot))
        slot, rank, dart = slot[order], rank[order], dart[order]
        lead = np.flatnonzero(np.diff(slot, prepend=-1))
        lead = lead[rank[lead] < best[slot[lead]]]
        best[slot[lead]], value[slot[lead]] = rank[lead], dart[lead]
        open_rows &= ~np.isfinite(best.reshape(rows, COORDINATES)).all(1)
        low, high = high.copy(), high + step
    return value.reshape(rows, COORDINATES), total > 0


def _weights(row: np.ndarray, element: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, element) in order with their weights: 1, or how often the row has the element."""
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    lead = np.flatnonzero((np.diff(row, prepend=-1) != 0) | np.concatenate([[True], element[1:] != element[:-1]])[: len(row)])
    count = np.diff(lead, append=len(row))
    return row[lead], element[lead], count.astype(float) if weighted else np.ones(len(lead))


def band_keys(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """(doc_id, digest, bands) of every row: digest of the whole text, and its band keys (none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[np.ndarray | None] = [None] * batch.num_rows
            for low, high, data, offsets in slices(batch.column("text"), 1 << 18):
                row, element, weight = _weights(*shingles(data, offsets, WORDS), weighted)
                value, full = signatures(row, element, weight, high - low)
                bands = np.zeros((high - low, BANDS), U64)
                for j in range(ROWS):
                    bands = mixed(bands + value[:, j::ROWS] + U64(j + 1))
                bands = mixed(bands + np.arange(BANDS, dtype=U64)[None, :]).view(np.int64)
                for i in np.flatnonzero(full):
                    keys[low + i] = bands[i]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "digest", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), "text")
    return bounded_batches(rows).mapInArrow(run, "doc_id long, digest binary, bands array<long>")


def _digest():
    """16 bytes that stand for a whole text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def shingle_sets(texts: DataFrame, weighted: bool = False) -> DataFrame:
    """(digest, elements) of (digest, text): the sorted distinct shingle hashes; weighted, one per repetition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = [np.zeros(0, np.int64)] * batch.num_rows
            for low, high, data, offsets in slices(batch.column("text")):
                row, element, weight = _weights(*shingles(data, offsets, WORDS), weighted)
                if weighted:  # the n-th copy of an element is an element of its own
                    copies = weight.astype(int)
                    nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                    row, element = np.repeat(row, copies), np.where(nth > 0, mixed(np.repeat(element, copies) + nth.astype(U64)), np.repeat(element, copies))
                cut = np.searchsorted(row, np.arange(high - low + 1))
                for i in range(high - low):
                    out[low + i] = np.sort(element[cut[i] : cut[i + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out, pa.list_(pa.int64()))], ["digest", "elements"])

    return bounded_batches(texts).select("digest", "text").mapInArrow(run, "digest binary, elements array<long>")


def _close(left: str, right: str, least: float):
    """Jaccard similarity of two array columns is at least `least`; the sizes alone often decide."""
    common = F.size(F.array_intersect(left, right))
    small, large = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    return (small >= least * large) & (common >= least * (F.size(left) + F.size(right) - common))


def _joining_links(group: pd.DataFrame, least: float) -> list[tuple[bytes, bytes]]:
    """Links between different classes of one block pair that suffice to join what belongs together."""
    group = group.sort_values("digest", ignore_index=True)
    sets = group["elements"].to_list()
    size = np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    root = {c: c for c in set(group["class"])}

    def find(c: bytes) -> bytes:
        while root[c] != c:
            c = root[c] = root[root[c]]
        return c

    classes, links = group["class"].to_list(), []
    side = group["side"].to_numpy()
    present = np.zeros(len(names), np.int32)
    for i in range(len(sets)):
        own = at[starts[i] : starts[i] + size[i]]
        present[own] = 1
        common = np.add.reduceat(present[at], starts)
        present[own] = 0
        near = (common >= least * (size + size[i] - common)) & (np.arange(len(sets)) > i) & ((side != side[i]) | (side == 2))
        for j in np.flatnonzero(near):
            a, b = find(classes[i]), find(classes[j])
            if a != b:
                root[a] = b
                links.append((group["digest"][i], group["digest"][j]))
    return links


def _rest(multi: DataFrame, classes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between classes that still meet in a bucket, found block by block."""
    rows = multi.join(classes.withColumnRenamed("node", "digest"), "digest", "left").select("key", "digest", F.coalesce("root", "digest").alias("class"))
    rows = stored(rows, "near-rest")
    mixed_keys = rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high").select("key")
    rows = rows.join(stored(mixed_keys, "near-mixed"), "key").join(sets, "digest")
    rows = stored(rows, "near-blocks")
    weight = rows.groupBy("key").agg(F.sum(F.size("elements")).alias("weight")).select("key", F.ceil(F.col("weight") / BLOCK_ELEMENTS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    rows = rows.join(stored(weight, "near-weights"), "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise(F.when(F.col("own") < F.col("other"), 0).otherwise(1))
    rows = rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), side.alias("side"), "digest", "class", "elements")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_joining_links(group, least), columns=["a", "b"])

    return rows.groupBy("key", "p", "q").applyInPandas(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """(doc_id, class_id, n_copies, kept) for every row of docs: the classes of texts linked by similarity.

    class_id is the smallest doc_id of the class and n_copies the rows with exactly this text. Texts
    are linked if they are equal or the Jaccard similarity of their shingle sets (weighted: of the
    shingle counts) is `similarity` or more; a candidate pair at exactly 0.8 is found with probability above 0.999.
    Null text counts as empty; texts without words link only with equal ones. Rows without an id take part, with
    class_id of the class; kept is true where doc_id equals class_id (repeated rows of one id are all marked). Empty tables give no row.
    """
    return _classes(docs, similarity, weighted).drop("digest", "root")


def _classes(docs: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """The rows of near_duplicates with the digest of their text and the root of their class, which no other class has."""
    rows = stored(band_keys(docs, weighted), "near-bands")
    texts = stored(
        rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")), "near-texts"
    )
    bands = texts.select(F.explode("bands").alias("key"), "digest")
    sizes = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-sizes")
    met = stored(bands.join(sizes, "key"), "near-met")
    hubs = met.groupBy("digest").agg(F.sum("n").alias("score"))
    ranked = stored(met.select("key", "digest").join(hubs, "digest"), "near-ranked")
    multi = ranked.select("key", "digest")
    hub = stored(ranked.groupBy("key").agg(F.max_by("digest", F.struct("score", "digest")).alias("a")), "near-hubs")
    pairs = stored(multi.join(hub, "key").filter("a != digest").select("a", F.col("digest").alias("b")).distinct(), "near-pairs")
    wanted = texts.join(hubs.select("digest"), "digest", "left_semi").select("first_id", "digest")
    source = docs.select(F.col("doc_id").cast("long").alias("first_id"), _digest().alias("digest"), "text")
    wanted = stored(wanted.select(F.col("first_id").alias("w_id"), F.col("digest").alias("w_digest")), "near-wanted")
    # Merged whatever its size: the wanted texts grow with the input, and so the plan is the same for every input.
    found = source.hint("merge").join(wanted, source["first_id"].eqNullSafe(wanted["w_id"]) & (source["digest"] == wanted["w_digest"]), "left_semi")
    sets = shingle_sets(found, weighted).groupBy("digest").agg(F.first("elements").alias("elements"))
    sets = stored(sets, "near-sets")
    left = pairs.join(sets.withColumnRenamed("digest", "b").withColumnRenamed("elements", "b_set"), "b")
    both = left.join(sets.withColumnRenamed("digest", "a").withColumnRenamed("elements", "a_set"), "a")
    stars = stored(both.filter(_close("a_set", "b_set", similarity)).select("a", "b"), "near-stars")
    classes = components(stars, "near-classes")
    rest = stored(_rest(multi, classes, sets, similarity), "near-more")
    roots = components(stars.union(rest), "near-roots")
    named = texts.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select("digest", F.coalesce("root", "digest").alias("root"), "first_id", "n_copies")
    named = stored(named, "near-named")
    least = stored(named.groupBy("root").agg(F.min("first_id").alias("class_id")), "near-least")
    named = stored(named.join(least, "root").select("digest", "root", "n_copies", "class_id"), "near-class")
    out = rows.select("doc_id", "digest").join(named, "digest")
    return out.select("doc_id", "class_id", "n_copies", (F.col("doc_id") == F.col("class_id")).alias("kept"), "digest", "root")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each class: the one with the smallest id. Rows without an id stay.

    Of repeated rows of a class with that id one stays; texts of different classes that share an id all stay. Columns are unchanged, whatever their names.
    """
    keep = _classes(docs, similarity, False).filter("kept").groupBy("root").agg(F.min(F.struct(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))).alias("one"))
    keep = stored(keep.select("one.*"), "near-keep")
    own = packed(docs, own_id=F.col("doc_id"), own_digest=_digest())
    same = (F.col("own_id") == F.col("kept_id")) & (F.col("own_digest") == F.col("kept_digest"))
    named = own.join(keep, same, "left_semi").dropDuplicates(["own_id", "own_digest"]).select("row.*")
    return named.unionByName(docs.filter("doc_id is null"))
