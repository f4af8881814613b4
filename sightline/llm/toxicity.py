"""Toxicity by a convolutional text classifier trained in numpy.

Words (runs of letters and digits, lower case) are hashed to an embedding: the sum of those of the whole word and of its first
four and six bytes, so that unseen forms of a stem are like the seen ones. Filters of several widths slide over the whole text,
the maximum of each filter is kept, and a linear layer gives a logit. Embedding and filters are trained together: from random
weights on a bounded sample, which gives all tasks one common start, and from there on every labelled row. Rows are dealt by id
into replicas of about REPLICA rows; each replica goes on from the start, and the changes of the replicas are averaged.
The logit is shifted by a threshold calibrated on all rows kept from training, for the language that the text
appears to be in (found from the text alone), so that a score of CUT means the same in every language.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm import languages
from sightline.llm.kernels import slices, span_hashes, word_spans
from sightline.llm.tables import bounded_batches, stored

BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 15, 12, 8, (1, 2, 3)
PREFIXES = (None, 4, 6)
ROWS = BUCKETS * len(PREFIXES)
PER_CLASS, EPOCHS, RATE = 2000, 8, 0.08
LEAST_TEXTS = 3
REPLICA, REPLICA_EPOCHS, REPLICA_WORDS = 1 << 13, 4, 1 << 22  # rows, passes over them, words held at a time
BINS = 1 << 10  # logits are counted in bins of 1 / BINS
FINE = 1 << 20  # changes of weights are added as whole numbers of 1 / FINE, so that the order of tasks does not matter
CUT = 0.3
INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Network:
    """`table[w][j]`: what each hashed word adds to the filters of width w at place j, so that a score takes look-ups only."""

    table: list[list[np.ndarray]]
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    threshold: dict[str, float]
    common: float


def hashed_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets of every word (one for the word and each prefix), words per row) of slices of a text column."""
    lower = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    for low, high, data, offsets in slices(lower):
        starts, ends, row = word_spans(data, offsets, INSIDE)
        parts = [ends if n is None else np.minimum(ends, starts + n) for n in PREFIXES]
        words = np.stack([(span_hashes(data, starts, end) % np.uint64(BUCKETS)).astype(np.int64) + i * BUCKETS for i, end in enumerate(parts)], 1)
        yield low, high, words, np.bincount(row, minlength=high - low)


def _summed(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    out = table[words[:, 0]]
    for i in range(1, words.shape[1]):
        out += table[words[:, i]]
    return out


def _pooled(words: np.ndarray, count: np.ndarray, table: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """The maximum of every filter of one width over each row; rows shorter than the width pool what they have."""
    width = len(table)
    starts = np.cumsum(count) - count
    out = np.zeros((len(count), len(bias)), np.float32)
    full = np.flatnonzero(count > 0)
    if not len(full):
        return out
    left = np.repeat(starts + count, count) - np.arange(len(words))
    value = _summed(table[0], words)
    for j in range(1, width):
        later = _summed(table[j], words[j:])
        later[left[:-j] <= j] = 0  # the text ends before
        value[:-j] += later
    if width > 1:  # a window that runs over the end counts only where the row is shorter than the width
        value[(left < width) & (np.repeat(count, count) >= width)] = -np.inf
    out[full] = np.maximum(np.maximum.reduceat(value, starts[full], axis=0) + bias, 0)
    return out


def logits(network: Network, words: np.ndarray, count: np.ndarray) -> np.ndarray:
    pooled = np.concatenate([_pooled(words, count, t, b) for t, b in zip(network.table, network.bias)], 1)
    return pooled @ network.weight + network.offset


class Learner:
    """Weights and the sums of their squared slopes: stochastic gradient descent with per-weight rates (Adagrad) on cross-entropy."""

    def __init__(self, seed: int = 0):
        self.rng = rng = np.random.default_rng(seed)
        self.seed = seed
        self.embed = rng.normal(0, 0.1, (ROWS, SIZE)).astype(np.float32)
        self.known = np.zeros(ROWS, bool)
        self.filters = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.weight, self.offset = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32)
        self.squares = [np.full_like(x, 1e-3) for x in self.parts()]
        self.steps = np.zeros(ROWS, np.int64)  # how often the embedding of a bucket was moved

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.weight, self.offset, *self.filters, *self.bias]

    def meet(self, texts: list[np.ndarray]) -> None:
        """Buckets that at least LEAST_TEXTS of the texts hold are learnt; what fewer hold can only be learnt by heart."""
        held = np.zeros(ROWS, np.int64)
        for text in texts:
            held[np.unique(text)] += 1
        self.know(np.flatnonzero(held >= LEAST_TEXTS))

    def know(self, place: np.ndarray) -> None:
        """Unknown buckets get their random embedding, the same in every replica."""
        new = place[~self.known[place]]
        self.embed[new] = Learner(self.seed).embed[new]
        self.known[new] = True

    def _step(self, part: int, x: np.ndarray, at, slope: np.ndarray) -> None:
        square = self.squares[part]
        square[at] += slope**2
        x[at] -= RATE * slope / np.sqrt(square[at])

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int, share: np.ndarray | None = None) -> None:
        """`share` is what an error of each label counts; 1 without it."""
        counts = np.ones(2, np.float32) if share is None else share
        for _ in range(epochs):
            order = self.rng.permutation(len(texts))
            for low in range(0, len(order), 16):
                chosen = [i for i in order[low : low + 16] if len(texts[i])]
                if chosen:
                    self._batch([texts[i] for i in chosen], labels[chosen], counts)

    def _batch(self, texts: list[np.ndarray], labels: np.ndarray, counts: np.ndarray) -> None:
        words = np.concatenate(texts).astype(np.int64)
        bounds = np.cumsum([0, *map(len, texts)])
        x = _summed(self.embed, words)
        parts, best = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias):
            value = x @ f[0]
            for j in range(1, w):
                value[:-j] += x[j:] @ f[j]
            at = np.stack([low + value[low : max(low + 1, high - w + 1)].argmax(0) for low, high in zip(bounds, bounds[1:])])
            parts.append(value[at, np.arange(FILTERS)] + b)
            best.append(at)
        pooled = np.maximum(np.concatenate(parts, 1), 0)
        score = 1 / (1 + np.exp(-np.clip(pooled @ self.weight + self.offset[0], -30, 30)))
        error = ((score - labels) * counts[labels.astype(np.int64)] / len(texts)).astype(np.float32)
        back = np.outer(error, self.weight) * (pooled > 0)
        self._step(1, self.weight, slice(None), pooled.T @ error + 1e-4 * self.weight)
        self._step(2, self.offset, slice(None), np.array([error.sum()]))
        names, moves = [], []
        for k, (w, f, b) in enumerate(zip(WIDTHS, self.filters, self.bias)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            slope = np.zeros_like(f)
            r, c = np.nonzero(own)
            for j in range(w):
                inside = best[k][r, c] + j < bounds[r + 1]
                found, column = words[best[k][r, c][inside] + j], c[inside]
                pull = own[r, c][inside][:, None]
                learnt = self.known[found]
                held = self.embed[found]
                held[~learnt] = 0
                np.add.at(slope[j].T, column, pull * held.sum(1))
                names.append(found[learnt])
                moves.append(np.repeat(pull * f[j].T[column], learnt.sum(1), axis=0))
            self._step(3 + len(WIDTHS) + k, b, slice(None), own.sum(0))
            self._step(3 + k, f, slice(None), slope + 1e-4 * f)
        name = np.concatenate(names)
        if len(name):
            order = np.argsort(name, kind="stable")
            first = np.flatnonzero(np.diff(name[order], prepend=-1))
            touched = name[order][first]
            self._step(0, self.embed, touched, np.add.reduceat(np.concatenate(moves)[order], first, axis=0))
            self.steps[touched] += 1

    def dense(self) -> np.ndarray:
        """All weights but the embedding in rows of SIZE."""
        flat = np.concatenate([x.ravel() for x in self.parts()[1:]])
        return np.append(flat, np.zeros(-len(flat) % SIZE, np.float32)).reshape(-1, SIZE)

    def move(self, place: np.ndarray, change: np.ndarray) -> None:
        """Add changes to rows of the embedding (below ROWS) and of the other weights (from ROWS on)."""
        own = place < ROWS
        self.know(place[own])
        self.embed[place[own]] += change[own].astype(np.float32)
        rest = np.zeros(self.dense().shape)
        rest[place[~own] - ROWS] = change[~own]
        flat, at = rest.ravel().astype(np.float32), 0
        for x in self.parts()[1:]:
            x += flat[at : at + x.size].reshape(x.shape)
            at += x.size

    def network(self) -> Network:
        table = [[self.embed @ f[j] for j in range(w)] for w, f in zip(WIDTHS, self.filters)]
        return Network(table, self.bias, self.weight, float(self.offset[0]), {}, 0.0)


def start(texts: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Learner:
    learner = Learner(seed)
    learner.embed[:] = 0
    learner.meet(texts)
    learner.learn(texts, labels, EPOCHS)
    return learner


def best_threshold(logit: np.ndarray, label: np.ndarray, count: np.ndarray | None = None) -> float:
    """The logit that separates the labels best by balanced accuracy: the middle of the best gap. `count`: rows that each entry stands for."""
    order = np.argsort(logit, kind="stable")
    n = np.ones(len(logit)) if count is None else count[order]
    z, y = logit[order], label[order]
    caught = 1 - np.concatenate([[0], np.cumsum(n * y)]) / max(1, (n * y).sum())
    spared = np.concatenate([[0], np.cumsum(n * (1 - y))]) / max(1, (n * (1 - y)).sum())
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    value = caught + spared
    k = np.flatnonzero(value >= value.max() - 1e-12)
    return float((edges[k] + edges[k + 1]).sum() / 2 / len(k))


def _hashed_texts(column: pa.Array) -> Iterator[np.ndarray]:
    """Buckets within their kind (little-endian 16-bit) of the words of each row."""
    for _, _, words, count in hashed_words(column):
        yield from np.split((words % BUCKETS).astype("<u2"), np.cumsum(count)[:-1])


KINDS = np.arange(len(PREFIXES)) * BUCKETS


SCALE = 1 << 30


def _place(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("label")), F.lit(SCALE))


def _labelled(docs: DataFrame, known: DataFrame, usable: Callable[[str], Column], where: str, parts: int) -> DataFrame:
    """(label, place, text) of every row of docs that has a text and a known label and whose place fits, dealt by id into `parts`.

    Texts and labels of an id meet by one shuffle at every size, so that its partitions depend on the ids alone.
    """
    texts = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & usable("doc_id"))
    texts = texts.select("doc_id", F.lit(None).cast("int").alias("label"), _place("doc_id").alias("place"), "text")
    rows = texts.union(known.select("label_id", "label", "place", F.lit(None))).filter(where).repartition(parts, "doc_id")
    rows = rows.withColumn("label", F.max("label").over(Window.partitionBy("doc_id")))
    return rows.filter("label is not null and text is not null").select("label", "place", "text")


def train_on_all(rows: DataFrame, learner: Learner, share: np.ndarray) -> Learner:
    """The learner after every row: each partition goes on from the given weights, and the changes are averaged.

    Weights but the embedding are averaged by the partitions' rows, the embedding of a bucket by the steps that moved it. A partition holds the
    words of up to REPLICA_WORDS words (or one text) at a time and passes over these REPLICA_EPOCHS times.
    """
    common = rows.sparkSession.sparkContext.broadcast(learner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(common.value)
        own.rng, own.steps = np.random.default_rng(1), np.zeros(ROWS, np.int64)
        seen = size = 0
        texts: list[np.ndarray] = []
        labels: list[int] = []

        def portion() -> None:
            nonlocal seen, size
            held = [t + KINDS for t in texts]
            own.meet(held)
            own.learn(held, np.array(labels, np.float32), REPLICA_EPOCHS, share)
            seen, size = seen + len(texts), 0
            texts.clear()
            labels.clear()

        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), _hashed_texts(batch.column("text"))):
                if texts and size + len(text) > REPLICA_WORDS:
                    portion()
                texts.append(text)
                labels.append(label)
                size += len(text)
        if texts:
            portion()
        if not seen:
            return
        moved = np.flatnonzero(own.steps)
        place = np.concatenate([moved, ROWS + np.arange(len(own.dense()))])
        times = np.concatenate([own.steps[moved], np.full(len(own.dense()), seen)])
        before = copy.deepcopy(common.value)
        before.know(moved)
        change = np.concatenate([own.embed[moved] - before.embed[moved], own.dense() - before.dense()])
        whole = np.rint(change.astype(np.float64) * times[:, None] * FINE).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(times), *map(pa.array, whole.T.copy())], ["place", "times", *names])

    names = [f"d{i}" for i in range(SIZE)]
    changes = bounded_batches(rows).mapInArrow(run, "place long, times long, " + ", ".join(f"{n} long" for n in names))
    # As many rows as the learner has, whatever the input.
    got = changes.groupBy("place").agg(*[F.sum(n).alias(n) for n in ("times", *names)]).toArrow()
    if got.num_rows:
        change = np.stack([got.column(n).to_numpy() for n in names], 1) / FINE / got.column("times").to_numpy()[:, None]
        learner.move(got.column("place").to_numpy(), change)
    return learner


def calibrate(rows: DataFrame, network: Network, trees: languages.Trees) -> None:
    """Thresholds from every row: logits are counted by language, label and bin, so what reaches the driver is bounded by the bins."""
    shared = rows.sparkSession.sparkContext.broadcast((network, trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, grown = shared.value
        for batch in batches:
            z = np.concatenate([np.zeros(0), *(logits(net, words, count) for _, _, words, count in hashed_words(batch.column("text")))])
            names = languages.scored(grown)(batch.column("text"))[0]
            at = np.rint(np.clip(z, -64, 64) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column("label"), pa.array(at)], ["name", "label", "at"])

    counted = bounded_batches(rows).mapInArrow(run, "name string, label int, at int").groupBy("name", "label", "at").count().toArrow()
    names, label = np.array(counted.column("name").to_pylist()), counted.column("label").to_numpy().astype(np.float64)
    z, n = counted.column("at").to_numpy() / BINS, counted.column("count").to_numpy().astype(np.float64)
    network.common = best_threshold(z, label, n)
    for name in np.unique(names):
        own = names == name
        if min((n * label)[own].sum(), (n * (1 - label))[own].sum()) >= 10:
            network.threshold[str(name)] = best_threshold(z[own], label[own], n[own])


def fit(docs: DataFrame, labels: DataFrame, usable: Callable[[str], Column], per_class: int = PER_CLASS, seed: int = 0) -> tuple[Network, languages.Trees]:
    """The classifier from every labelled usable row, and the language trees its calibration uses.

    `usable` gives the condition on the named id column. At most `per_class` rows of each label give the weights from which all rows are learnt;
    if these are all rows, they are learnt there. A fifth of the rows is kept from training for the thresholds; a language with fewer than ten rows of either label there
    gets the common one. Rows with a null label or text are not used, nor are ids whose
    label rows disagree; repeated label rows count once. Other columns of docs play no part. Without rows of both labels every score is CUT.
    """
    trees = languages.fit(docs, usable("doc_id"))
    own = F.col("doc_id").try_cast(docs.schema["doc_id"].dataType)
    known = labels.select(own.alias("label_id"), F.col("toxic").cast("int").alias("label")).filter("label in (0, 1) and label_id is not null").filter(usable("label_id"))
    known = known.groupBy("label_id").agg(F.min("label").alias("label"), F.max("label").alias("top")).filter("label = top").drop("top")
    known = stored(known.withColumn("place", _place("label_id")), "toxic-labels")
    counts = dict(known.groupBy("label").count().collect())
    cut = F.coalesce(*[F.when(F.col("label") == k, F.lit(int(SCALE * min(1.0, 1.3 * per_class / n)))) for k, n in sorted(counts.items())], F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [text.tobytes() for text in _hashed_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), pa.array(words, pa.binary())], ["label", "place", "words"])

    sample = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(known.filter(F.col("place") < cut)), F.col("doc_id") == F.col("label_id")).select("label", "place", "text")
    got = sorted(bounded_batches(sample).mapInArrow(run, "label int, place long, words binary").collect(), key=lambda r: (r["place"], r["words"]))
    taken = {0: 0, 1: 0}
    chosen = []
    for row in got:
        if taken.get(row["label"], per_class) < per_class:
            taken[row["label"]] += 1
            chosen.append(row)
    texts = [np.frombuffer(r["words"], "<u2").reshape(-1, len(PREFIXES)) + KINDS for r in chosen]
    y = np.array([r["label"] for r in chosen], np.float32)
    if not taken[0] or not taken[1]:
        empty = Network([[np.zeros((ROWS, FILTERS), np.float32)] * w for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32), 0.0, {}, 0.0)
        return empty, trees
    apart = np.array([r["place"] % 5 == 0 for r in chosen])
    split = bool(0 < y[apart].sum() < apart.sum() and 0 < y[~apart].sum() < (~apart).sum())
    if not split:
        apart[:] = False
    learner = start([t for t, a in zip(texts, apart) if not a], y[~apart], seed)
    total = sum(counts.values())
    parts = -(-total // REPLICA)
    if len(chosen) < len(got) or max(counts.values()) > per_class:
        share = np.array([total / 2 / counts[0], total / 2 / counts[1]], np.float32)
        rows = _labelled(docs, known, usable, "place % 5 <> 0" if split else "true", parts)
        learner = train_on_all(rows.sortWithinPartitions("place", "text"), learner, share)
    network = learner.network()
    calibrate(_labelled(docs, known, usable, "place % 5 = 0" if split else "true", parts), network, trees)
    return network, trees


def score(docs: DataFrame, network: Network, trees: languages.Trees) -> DataFrame:
    """docs with toxicity, a value in [0, 1] from the text alone; CUT is the calibrated threshold. Null text counts as empty.

    Other columns and repeated rows are kept; a column named toxicity is replaced.
    """
    kept = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast((network, trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, grown = shared.value
        for batch in batches:
            z = np.concatenate([np.zeros(0), *(logits(net, words, count) for _, _, words, count in hashed_words(batch.column("text")))])
            names = languages.scored(grown)(batch.column("text"))[0]
            z = z - np.array([net.threshold.get(name, net.common) for name in names]) + np.log(CUT / (1 - CUT))
            value = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64())], [*batch.schema.names, "toxicity"])

    return bounded_batches(kept).mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("toxicity", T.DoubleType())]))
