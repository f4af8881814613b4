"""Language identification by prediction by partial matching over bytes.

Each language has a context tree: the counts of the byte that follows every context of up to three
bytes. A byte costs -log2 of its share in the longest context of the tree, or of the escape
share (method C: distinct followers against all followers) plus its cost one context shorter, down to a
uniform cost. The counts are frozen after training, so the cost of a byte depends on its
three predecessors only and is tabulated once for the union of the trees; the code length of a
whole text is then a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.kernels import slices
from sightline.llm.tables import bounded_batches

UNIFORM = 8.0
UNKNOWN = "und"


@dataclass
class Trees:
    """Frozen statistics. `classes`: byte to symbol (0: not seen in training, or start of text);
    `context`: three symbols to the row of the longest known context; `cost`: bits by row, symbol, language."""

    languages: list[str]
    classes: np.ndarray
    symbols: int
    context: np.ndarray
    cost: np.ndarray


def _escaped(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of each symbol in each context: counts (contexts, symbols), shorter: bits one context shorter."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = np.log2(total + kinds) - np.log2(counts)
        escape = np.log2(total + kinds) - np.log2(kinds)
    return np.where(total == 0, shorter, np.where(counts > 0, seen, escape + shorter)).astype(np.float32)


def grow(texts: dict[str, list[bytes]], least: int = 16) -> Trees:
    """Trees of labelled texts. Contexts of three bytes seen fewer than `least` times in every language are not kept."""
    languages = sorted(texts)
    present = np.zeros(256, bool)
    for group in texts.values():
        for text in group:
            present[np.frombuffer(text, np.uint8)] = True
    classes = np.zeros(256, np.int64)
    classes[present] = 1 + np.arange(present.sum())
    k = int(present.sum()) + 1
    keys = {}
    for name in languages:
        parts = [np.zeros(0, np.int64)]
        for text in texts[name]:
            c = np.concatenate([np.zeros(3, np.int64), classes[np.frombuffer(text, np.uint8)]])
            parts.append(((c[:-3] * k + c[1:-2]) * k + c[2:-1]) * k + c[3:])
        keys[name] = np.unique(np.concatenate(parts), return_counts=True)
    wanted: list[np.ndarray] = []
    for key, count in keys.values():
        context, at = np.unique(key // k, return_inverse=True)
        wanted.append(context[np.bincount(at, count, len(context)) >= least])
    third = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
    second = np.unique(np.concatenate([np.zeros(0, np.int64), *(key // k % (k * k) for key, _ in keys.values())]))
    # Rows: the contexts of one symbol, the seen ones of two, the kept ones of three.
    pair = np.tile(np.arange(k, dtype=np.int32), k)
    pair[second] = k + np.arange(len(second), dtype=np.int32)
    context = np.tile(pair, k)
    context[third] = k + len(second) + np.arange(len(third), dtype=np.int32)
    cost = np.zeros((k + len(second) + len(third), k, len(languages)), np.float32)
    for i, name in enumerate(languages):
        key, count = keys[name]
        order2 = np.bincount(key % k**3, count, k**3).reshape(k * k, k)
        order1 = order2.reshape(k, k, k).sum(0)
        bits0 = _escaped(order1.sum(0, keepdims=True), np.full((1, k), UNIFORM, np.float32))
        bits1 = _escaped(order1, bits0)
        bits2 = _escaped(order2, np.tile(bits1, (k, 1)))
        row = np.minimum(np.searchsorted(third, key // k), max(0, len(third) - 1))
        own = third[row] == key // k if len(third) else np.zeros(len(key), bool)
        order3 = np.bincount(row[own] * k + key[own] % k, count[own], len(third) * k).reshape(len(third), k)
        cost[:, :, i] = np.concatenate([bits1, bits2[second], _escaped(order3, bits2[third % (k * k)])])
    return Trees(languages, classes, k, context, cost.reshape(len(cost) * k, len(languages)))


def code_lengths(trees: Trees, column: pa.Array) -> np.ndarray:
    """Bits of every text (rows) in every language (columns)."""
    out = np.zeros((len(column), len(trees.languages)))
    k = trees.symbols
    for low, high, data, offsets in slices(column, 1 << 19):
        if not len(data):
            continue
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        c = trees.classes[data]
        first = np.concatenate([[0], c[:-1]])
        first[begins] = 0
        second = np.concatenate([[0], first[:-1]])
        second[begins] = 0
        third = np.concatenate([[0], second[:-1]])
        third[begins] = 0
        row = trees.context[(third * k + second) * k + first].astype(np.int64)
        full = np.flatnonzero(offsets[:-1] < offsets[1:])
        out[low + full] = np.add.reduceat(trees.cost[row * k + c], begins, axis=0, dtype=np.float64)
    return out


def labelled_texts(docs: DataFrame, label: str, per_label: int, usable: Column) -> dict[str, list[bytes]]:
    """Up to `per_label` whole texts of each label: those with the least hashed ids. The bound holds for what reaches the driver."""
    known = docs.filter(usable & F.col(label).isNotNull() & F.col("text").isNotNull())
    counts = {row[0]: row[1] for row in known.groupBy(label).count().collect()}
    if not counts:
        return {}
    place = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    scale = 1 << 30
    # Twice the wanted share passes, so that the least ones are among them; a label with few rows passes whole.
    cut = F.coalesce(*[F.when(F.col(label) == name, F.lit(int(scale * min(1.0, 2 * per_label / n + 0.0)))) for name, n in sorted(counts.items())])
    rows = known.filter(F.pmod(place, F.lit(scale)) < cut).select(F.col(label).alias("label"), F.pmod(place, F.lit(scale)).alias("place"), "doc_id", "text").collect()
    out: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["label"], r["place"], r["doc_id"], r["text"])):
        if len(group := out.setdefault(row["label"], [])) < per_label:
            group.append(row["text"].encode())
    return out


def fit(docs: DataFrame, usable: Column, per_language: int = 150) -> Trees:
    """Trees of at most `per_language` whole texts of each value of lang among the usable rows."""
    return grow(labelled_texts(docs, "lang", per_language, usable))


def scored(trees: Trees) -> Callable[[pa.Array], tuple[list, np.ndarray, np.ndarray]]:
    """A function of a text column that gives the language, the posterior share, and bits per byte of each row."""

    def apply(column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        size = np.maximum(1, pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        if not trees.languages:
            return [UNKNOWN] * len(column), np.zeros(len(column)), np.full(len(column), UNIFORM)
        bits = code_lengths(trees, column)
        best = bits.argmin(1)
        low = bits.min(1) if len(bits) else np.zeros(0)
        share = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
        names = [trees.languages[b] if has else UNKNOWN for b, has in zip(best, letters)]
        return names, np.where(letters, share, 0.0), low / size

    return apply


def identify(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with lang_pred, lang_score and lang_bits (bits per byte in that language).

    A null text, or one without a letter, gets `und` and score 0; ties go to the first language by name.
    Without any training row every text gets `und`. Other columns, nulls and repeated rows pass unchanged;
    columns of the three names are replaced.
    """
    kept = docs.drop("lang_pred", "lang_score", "lang_bits")
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = scored(shared.value)
        for batch in batches:
            names, share, bits = apply(batch.column("text"))
            extra = [pa.array(names, pa.string()), pa.array(share, pa.float64()), pa.array(bits, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "lang_pred", "lang_score", "lang_bits"])

    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_bits", T.DoubleType())]
    return bounded_batches(kept).mapInArrow(run, T.StructType([*kept.schema.fields, *extra]))
