"""Ranked lexical search, reversed: the queries are indexed and the documents stream through the index.

The few items are inverted (term, items that hold it and how often) and sent to every task. A first pass reduces each whole
document to its length and its counts of the items' terms, which are stored; from them come the corpus statistics (documents, words,
documents holding a term). A second pass streams the stored counts through the index: what a term of a document is worth goes to
the items that hold it, and each item keeps a heap of its best documents so far. A task returns its heaps, which are
merged in two steps, so that no task gets the heaps of all others.

The index is bounded: items are cut into portions of up to PORTION bytes of text and each portion is searched by itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.tables import bounded_batches, stored
from sightline.llm.words import Vocabulary, hashed_words

PORTION = 4 << 20  # bytes of item text in one index
CELLS = 1 << 21  # scores (documents by items) or terms' shares worked on at once
MERGED = 64  # groups of documents in which an item's heaps are merged first
RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass
class Index:
    """Items by term: the postings of term t are those from ends[t] to ends[t + 1]."""

    terms: list[str]
    ends: np.ndarray
    item: np.ndarray
    times: np.ndarray
    n_items: int


def terms_of(text: str | None) -> list[str]:
    """The terms of a text in order, repeats included."""
    out, run = [], []
    for c in (text or "") + " ":
        if c.isalnum() if c.isascii() else True:
            run.append(c.lower() if c.isascii() else c)
        elif run:
            out.append("".join(run))
            run = []
    return out


def inverted(texts: list[str | None]) -> Index:
    lists: dict[str, list[tuple[int, int]]] = {}
    for i, text in enumerate(texts):
        for term, times in Counter(terms_of(text)).items():
            lists.setdefault(term, []).append((i, times))
    terms = sorted(lists)
    flat = [posting for term in terms for posting in lists[term]]
    item, times = (np.array(x, np.int64) for x in zip(*flat)) if flat else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    ends = np.concatenate([[0], np.cumsum([len(lists[t]) for t in terms], dtype=np.int64)]).astype(np.int64)
    return Index(terms, ends, item, times, len(texts))


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs): words of each whole text, and the numbers of the given terms it holds with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = Vocabulary(terms), max(1, len(terms))
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for row, _, value in hashed_words(batch.column("text")):
                n += np.bincount(row, minlength=batch.num_rows)
                number = known.numbers(value)
                new, times = np.unique((row * size + number)[number >= 0], return_counts=True)
                if len(keys) and len(new) and new[0] <= keys[-1]:  # a piece of the same text
                    keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([counts, times])).astype(np.int64)
                else:
                    keys, counts = np.concatenate([keys, new]), np.concatenate([counts, times])
            ends = pa.array(np.searchsorted(keys, np.arange(batch.num_rows + 1) * size), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((keys % size, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded_batches(rows).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Heaps:
    """The best documents of every item so far: score, whether the id is null, id."""

    def __init__(self, n_items: int, most: int):
        self.n_items, self.most = n_items, most
        self.item, self.score, self.none, self.doc = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        self.least = np.ones(n_items, np.int64)  # a document below this score is not among the best

    def add(self, item: np.ndarray, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        item, score, none, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.none, none), (self.doc, doc)))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, nth = order[nth < self.most], item[nth < self.most], nth[nth < self.most]
        self.item, self.score, self.none, self.doc = item, score[order], none[order], doc[order]
        full = nth == self.most - 1
        self.least[item[full]] = self.score[full]


def _scores(index: Index, weights: np.ndarray, row: np.ndarray, term: np.ndarray, worth: np.ndarray, rows: int) -> np.ndarray:
    """Exact scores, documents by items: each (document, term)'s worth goes to all items of the term, times its repeats there."""
    degree = index.ends[term + 1] - index.ends[term]
    ends = np.cumsum(degree)
    at = np.repeat(index.ends[term] - (ends - degree), degree) + np.arange(ends[-1] if len(ends) else 0)
    cell, share = np.repeat(row * index.n_items, degree) + index.item[at], np.repeat(worth, degree) * index.times[at]
    if weights.sum() and np.bincount(index.item, np.repeat(weights, np.diff(index.ends)) * index.times).max() * 1e6 < 2**53:
        flat = np.bincount(cell, share, minlength=rows * index.n_items).astype(np.int64)  # sums are exact in doubles
    else:
        flat = np.zeros(rows * index.n_items, np.int64)
        np.add.at(flat, cell, share)
    return flat.reshape(rows, index.n_items)


def _streamed(counts: DataFrame, index: Index, weights: np.ndarray, keys: list[int], n_docs: int, n_words: int, most: int) -> DataFrame:
    """(item, score, doc_id): the heaps of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.n_items, most)
        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy().astype(np.int64)
            term = lists.flatten().to_numpy().astype(np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            m = 25 + 75 * batch.column("n").to_numpy() * n_docs // n_words
            worth = weights[term] * (10**9 * tfs // (1000 * tfs + 8 * m[row]))
            doc = batch.column("doc_id")
            none, doc = doc.is_null().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy()
            shares = np.concatenate([[0], np.cumsum(index.ends[term + 1] - index.ends[term])])
            first = np.concatenate([[0], np.cumsum(sizes)])
            low = 0
            while low < batch.num_rows:
                # Rows whose scores and shares both fit, or one row.
                high = int(np.searchsorted(shares[first], shares[first[low]] + CELLS, "right")) - 1
                high = max(low + 1, min(high, low + max(1, CELLS // index.n_items), batch.num_rows))
                own = slice(first[low], first[high])
                score = _scores(index, weights, row[own] - low, term[own], worth[own], high - low)
                r, i = np.nonzero(score >= heaps.least)
                heaps.add(i, score[r, i], none[low + r], doc[low + r])
                low = high
        out = [pa.array(np.array(keys, np.int64)[heaps.item]), pa.array(heaps.score), pa.array(heaps.doc, pa.int64(), mask=heaps.none)]
        yield pa.RecordBatch.from_arrays(out, ["item", "score", "doc_id"])

    return counts.mapInArrow(run, "item long, score long, doc_id long")


def _best(heaps: DataFrame, most: int) -> DataFrame:
    """The heaps of all tasks merged: first within groups of documents, then the groups' winners."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    group = F.pmod(F.xxhash64("doc_id"), F.lit(MERGED))
    first = heaps.withColumn("group", group).withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order)))
    first = first.filter(F.col("rank") <= most).drop("rank", "group")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= most)


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the `most` best documents of every item, by a saturating term weight in whole numbers.

    N documents have a term, L is all their words. A term that df documents hold weighs w = floor(1000 ln((2N+2)/(2df+1))), and a
    document of n words that holds it tf times scores w * (10**9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, for each of the
    item's terms, repeats included. Scores above 0 rank by score, then by id, null ids last; equal rows rank one after the other. Repeated
    items are ranked each; null and empty texts on either side have no terms and no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    items = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("nth")), "search-items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    portions = -(-size // PORTION)
    found = []
    for k in range(portions):
        rows = items.filter(F.pmod(F.xxhash64("nth"), F.lit(portions)) == k).select("nth", "text").toArrow().to_pydict()
        index = inverted(rows["text"])
        counts = stored(term_counts(docs, index.terms), "search-counts")
        n_docs, n_words = counts.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not index.terms:
            continue
        df = np.zeros(len(index.terms))
        for term, holding in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the index
            df[term] = holding
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.astype(int).tolist()], np.int64)
        heaps = _streamed(counts, index, weights, rows["nth"], n_docs, n_words, most)
        found.append(_best(heaps, most).join(items.select(F.col("nth").alias("item"), "item_id"), "item"))
    if not found:
        return spark.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, found).select("item_id", "rank", "doc_id", "score")
