"""Near-duplicate vectors by product quantisation over inverted lists.

Equal vectors are collapsed first. A coarse quantiser (k-means of a bounded sample of directions) puts each distinct vector into
the list of its nearest centroid; its residual is coded by product quantisation (a codebook per subspace), and the length of
what the code misses is kept beside it. A query probes every list whose half-plane, between the list's centroid and the query's own,
is no farther than a partner at the wanted cosine goes along that axis. How much of a partner's whole distance that is depends
on the directions in which partners differ, so it is taken from the data: the exact partners of QUERIES vectors, found in one linear
scan of all rows, give the smallest share that loses at most LOSS of a query's partners, three more losing queries than
were seen allowed for. With too few partners to tell, or with loss=0 (the default), the share is 1, which loses no pair at all. One side of a pair asks for both.
Neighbouring lists form cells; a vector is sent to
a cell once, however many of its lists it probes, and is held against the probed lists only, and in them only if the triangle
inequality over the centroid leaves a partner possible. In a list, table-lookup distances (query against code) discard a vector only
if they exceed that distance by more than what its code misses; what passes is ranked again by the exact cosine in double precision.
Cells are cut into blocks of bounded size, and every block meets the blocks of queries that ask it in a task of its own, which reports
how many links each vector has and as many links as join what belongs together, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.graph import components
from sightline.llm.tables import bounded_batches, stored

COSINE = 0.9
SAMPLE = 20_000
LIST_SIZE = 256
MOST_LISTS = 1 << 14
QUERIES, NEAR_LISTS, BINS = 1 << 13, 8, 100
LOSS = 0.01
CODES = 64
BLOCK = 2048
SLACK = 1e-6


@dataclass
class Index:
    centroids: np.ndarray  # lists x dimensions
    books: list[np.ndarray]  # per subspace: codes x its dimensions
    cuts: list[int]  # first dimension of each subspace, and the end


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(center, squared distance less the point's own square) of the center nearest to each point, in bounded memory."""
    square, step = (centers**2).sum(1), max(1, (1 << 22) // len(centers))
    near, gap = np.zeros(len(points), np.int64), np.zeros(len(points))
    for low in range(0, len(points), step):
        part = square - 2 * points[low : low + step] @ centers.T
        near[low : low + step], gap[low : low + step] = part.argmin(1), part.min(1)
    return near, gap


def k_means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of points; an empty cluster takes the point farthest from its own."""
    rng = np.random.default_rng(seed)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near, gap = nearest(points, centers)
        gap += (points**2).sum(1)
        count = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, near, points)
        centers[count > 0] = total[count > 0] / count[count > 0, None]
        for c in np.flatnonzero(count == 0):
            far = gap.argmax()
            centers[c], gap[far] = points[far], -np.inf
    return centers


def build_index(sample: np.ndarray, lists: int, seed: int = 0) -> Index:
    """Index of unit vectors (rows of sample)."""
    centroids = k_means(sample, lists, 8, seed)
    rest = sample - centroids[nearest(sample, centroids)[0]]
    d = sample.shape[1]
    parts = max(1, min(d, d // 8))
    cuts = [round(i * d / parts) for i in range(parts + 1)]
    return Index(centroids, [k_means(rest[:, a:b], CODES, 8, seed + 1 + i) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))], cuts)


def encode(index: Index, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list, codes, missed length) of unit vectors."""
    where = nearest(units, index.centroids)[0]
    rest = units - index.centroids[where]
    codes = np.zeros((len(units), len(index.books)), np.uint8)
    missed = np.zeros(len(units))
    for i, book in enumerate(index.books):
        part = rest[:, index.cuts[i] : index.cuts[i + 1]]
        codes[:, i] = ((book**2).sum(1) - 2 * part @ book.T).argmin(1)
        missed += ((part - book[codes[:, i]]) ** 2).sum(1)
    return where, codes, np.sqrt(missed)


def cells_of(centroids: np.ndarray, most: int) -> np.ndarray:
    """The cell of each list: halves of halves along the widest axis, of at most `most` lists."""
    cells, parts, n = np.zeros(len(centroids), np.int64), [np.arange(len(centroids))], 0
    while parts:
        part = parts.pop()
        if len(part) <= most:
            cells[part], n = n, n + 1
            continue
        rest = centroids[part] - centroids[part].mean(0)
        axis = np.linalg.eigh(rest.T @ rest)[1][:, -1]
        parts += np.array_split(part[np.argsort(rest @ axis, kind="stable")], 2)
    return cells


def probes(index: Index, units: np.ndarray, own: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
    """query x list: whether the list can hold a vector within `reach` of the query, whose own list is `own`."""
    square, at, to = (index.centroids**2).sum(1), index.centroids[own], index.centroids[lists]
    gap = square[lists] - 2 * units @ to.T - (square[own] - 2 * (units * at).sum(1))[:, None]
    between = np.sqrt(np.maximum(0, square[own][:, None] + square[lists] - 2 * at @ to.T))
    return (gap <= 2 * (reach + SLACK) * between + SLACK) | (own[:, None] == lists)


def near_lists(index: Index, units: np.ndarray) -> np.ndarray:
    """The lists nearest to each unit vector in order, its own first, NEAR_LISTS beside it at most."""
    square = (index.centroids**2).sum(1)
    return np.concatenate([np.argsort(square - 2 * units[low : low + 256] @ index.centroids.T, axis=1)[:, : NEAR_LISTS + 1] for low in range(0, len(units), 256)])


def direction_shares(index: Index, near: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Of each difference (row of step) from a vector with the near lists, the greatest share of its length along the axes to those lists, at least 0."""
    axes = index.centroids[near[:, 1:]] - index.centroids[near[:, :1]]
    size = np.sqrt((axes**2).sum(2)) * np.sqrt((step**2).sum(1))[:, None]
    along = np.matmul(axes, step[:, :, None])[:, :, 0]
    return np.clip(np.divide(along, size, out=np.zeros_like(along), where=size > SLACK).max(1, initial=0), 0, 1)


def least_share(found: list[tuple[int, float]], n: int, loss: float) -> float:
    """The smallest share of which, by `found` (bin, partners of it as parts of their query's own, summed) over n queries, at most `loss` is lost."""
    per_bin = np.zeros(BINS)
    for at, weight in found:
        per_bin[at] += weight
    lost = n - np.cumsum(per_bin)
    enough = np.flatnonzero(lost + 3 <= loss * n)
    return float(enough[0] + 1) / BINS if len(enough) else 1.0


def asking(own: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether a vector of cell `own` asks `cell`: of two cells one asks the other, and each about as many as ask it."""
    return (own == cell) | ((own > cell) ^ ((own + cell) % 2 == 1))


def close_pairs(index: Index, where: int, q: np.ndarray, x: np.ndarray, codes: np.ndarray, missed: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, vector row) with exact cosine of at least `cosine`, after table-lookup distances to the codes."""
    reach = np.sqrt(2 - 2 * cosine)
    units = q / np.linalg.norm(q, axis=1, keepdims=True)
    rest = units - index.centroids[where]
    # Partners are about as far from the centroid as the query is.
    far, radii = np.sqrt((rest**2).sum(1)), np.sqrt(((x / np.linalg.norm(x, axis=1, keepdims=True) - index.centroids[where]) ** 2).sum(1))
    some = np.flatnonzero((far <= radii.max() + reach + SLACK) & (far >= radii.min() - reach - SLACK))
    q, rest = q[some], rest[some]
    distance = np.zeros((len(q), len(x)))
    for i, book in enumerate(index.books):
        part = rest[:, index.cuts[i] : index.cuts[i + 1]]
        lookup = (part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T
        distance += lookup[:, codes[:, i]]
    a, b = np.nonzero(np.sqrt(np.maximum(0, distance)) <= reach + missed[None, :] + SLACK)
    exact = np.zeros(len(a))
    for low in range(0, len(a), 1 << 16):
        part = slice(low, low + (1 << 16))
        exact[part] = (q[a[part]] * x[b[part]]).sum(1)
    exact /= np.linalg.norm(q, axis=1)[a] * np.linalg.norm(x, axis=1)[b]
    return some[a[exact >= cosine]], b[exact >= cosine]


def joining(asked: np.ndarray, held: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (asked, held), in order of asked, those that join parts not yet joined; `label` of every node is kept up to date."""
    out = []
    bounds = np.flatnonzero(np.diff(asked, prepend=-1, append=-1))
    for low, high in zip(bounds, bounds[1:]):
        i, near = asked[low], held[low:high]
        labels, first = np.unique(label[near], return_index=True)
        new = labels != label[i]
        if new.any():
            out += [(i, j) for j in near[first[new]]]
            label[np.isin(label, labels[new])] = label[i]
    return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    values = column.flatten() if len(column) else pa.array([], pa.float64())
    return values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def link_vectors(rows: DataFrame, cosine: float = COSINE, seed: int = 0, loss: float = 0.0) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    n_links counts the other rows found with a cosine of at least `cosine`: all of them by default; with `loss` above 0, such as LOSS, of a
    vector's partners at most that share is expected to be missed, and none below the cosine is counted. component_id is the smallest vec_id reachable by links and
    kept tells whether it is the row's own. Null and zero vectors, and those with a null or non-finite component, link
    with nothing; vectors of different dimensions neither. Repeated rows are rows of their own; a null vec_id links but names
    a component only if nothing else does. An empty table gives no row.
    """
    spark = rows.sparkSession
    # Single-precision components are kept as such up to the tasks, which compute in double precision.
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"
    values = F.col("embedding").cast("array<float>" if single else "array<double>")
    good = F.col("embedding").isNotNull() & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(values, lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, values).alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast("float" if single else "double")))  # -0.0 becomes 0.0
    rows = stored(rows.withColumn("key", F.when(F.col("v").isNotNull(), F.unhex(F.md5(F.array_join(F.transform("v", lambda x: x.cast("string")), ",").cast("binary"))))), "vec-rows")
    texts = stored(rows.filter("v is not null").groupBy("key").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), "vec-distinct")
    links = None
    for d, n in sorted((r[0], r[1]) for r in texts.groupBy(F.size("v")).count().collect()):
        found = _links_of_size(spark, texts.filter(F.size("v") == d), d, n, cosine, seed, loss)
        links = found if links is None else links.union(found)
    alone = rows.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if links is None:
        return alone.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    found = stored(links, "vec-links")
    counted = found.filter("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("linked").alias("linked"))
    roots = components(found.filter("b is not null").select("a", "b"), "vec-roots").withColumnRenamed("node", "key")
    named = texts.select("key", "least_id", "copies").join(counted, "key", "left").join(roots, "key", "left")
    named = stored(named.select("key", "least_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")), "vec-named")
    least = stored(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "vec-least")
    named = stored(named.join(least, "root").select("key", "n_links", "component_id"), "vec-class")
    out = rows.filter("v is not null").select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    return out.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def probe_share(texts: DataFrame, index: Index, names: np.ndarray, units: np.ndarray, cosine: float, loss: float) -> float:
    """The share of a partner's distance that probes must go, from the exact partners of the queries (keys and unit vectors) among all texts."""
    shared = texts.sparkSession.sparkContext.broadcast((index, names, units, near_lists(index, units)))
    d = units.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names, units, near = shared.value
        count = np.zeros((len(units), BINS), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                x = _matrix(part.column("v"), d)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                i, j = np.nonzero(x @ units.T >= cosine)
                other = np.array(part.column("key").to_pylist(), object)[i] != names[j]
                i, j = i[other], j[other]
                for at in range(0, len(i), 1 << 12):
                    a, b = i[at : at + (1 << 12)], j[at : at + (1 << 12)]
                    np.add.at(count, (b, np.minimum(BINS - 1, (direction_shares(index, near[b], x[a] - units[b]) * BINS).astype(int))), 1)
        q, at = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(at, pa.int32()), pa.array(count[q, at])], ["q", "at", "n"])

    seen = stored(bounded_batches(texts).select("key", "v").mapInArrow(run, "q int, at int, n long").groupBy("q", "at").agg(F.sum("n").alias("n")), "vec-shares")
    whole = seen.groupBy("q").agg(F.sum("n").alias("whole"))
    found = seen.join(whole, "q").groupBy("at").agg(F.sum(F.col("n") / F.col("whole")).alias("part")).collect()
    return least_share([(r["at"], r["part"]) for r in found], whole.count(), loss)


def _links_of_size(spark, texts: DataFrame, d: int, n: int, cosine: float, seed: int, loss: float) -> DataFrame:
    """Rows about distinct vectors of one dimension: (a, null, rows linked with a in one task), and (a, b, 0) for links that join all parts."""
    share = min(1.0, 1.2 * SAMPLE / n)
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    picked = texts.filter(place <= int(share * (1 << 30))).select(place.alias("place"), "key", "v").toArrow()
    picked = picked.sort_by([("place", "ascending"), ("key", "ascending")]).slice(0, SAMPLE).combine_chunks()
    sample = _matrix(picked.column("v").combine_chunks(), d)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    index = build_index(sample, max(1, min(MOST_LISTS, len(sample), -(-n // LIST_SIZE))), seed)
    reach = float(np.sqrt(2 - 2 * cosine))
    if loss > 0:
        names = np.array(picked.column("key").slice(0, QUERIES).to_pylist(), object)
        reach *= probe_share(texts, index, names, sample[:QUERIES], cosine, loss)
    cells = cells_of(index.centroids, max(1, BLOCK // LIST_SIZE))
    shared = spark.sparkContext.broadcast((index, cells))
    rows_at_once = max(16, min(1024, (1 << 22) // len(index.centroids)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cells = shared.value
        by_cell = np.argsort(cells, kind="stable")
        first = np.flatnonzero(np.diff(cells[by_cell], prepend=-1))
        for batch in batches:
            for low in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(low, rows_at_once)
                x = _matrix(part.column("v"), d)
                units = x / np.linalg.norm(x, axis=1, keepdims=True)
                where, codes, missed = encode(index, units)
                near = np.logical_or.reduceat(probes(index, units, where, by_cell, reach), first, axis=1)
                who, asks = np.nonzero(near & asking(cells[where][:, None], np.arange(len(first))))
                asks = np.split(asks.astype(np.int32), np.searchsorted(who, np.arange(1, len(x))))
                arrays = [
                    part.column("key"), part.column("copies"), part.column("v"), pa.array(where, pa.int32()), pa.array(cells[where], pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed), pa.array(asks, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "copies", "v", "list", "cell", "codes", "missed", "asks"])

    kind = texts.schema["v"].dataType.simpleString()
    schema = f"key binary, copies long, v {kind}, list int, cell int, codes binary, missed double, asks array<int>"
    rows = stored(bounded_batches(texts).select("key", "copies", "v").mapInArrow(coded, schema), "vec-coded")
    asked = rows.select("key", "copies", "v", "list", F.explode("asks").alias("cell"))
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asks = rows.select(F.explode("asks").alias("cell")).groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ask_blocks"))
    sizes = stored(sizes.join(asks, "cell"), "vec-sizes")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    held = rows.join(sizes, "cell").select("cell", own.alias("x"), F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("y"), "key", "copies", "v", "list", "codes", "missed")
    ask = F.pmod(F.xxhash64("key"), F.col("ask_blocks")).cast("int")
    asked = asked.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"), ask.alias("y"), "key", "copies", "v", "list",
        F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("missed"),
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        index, cells = shared.value
        held, asked = group[group["codes"].notna()], group[group["codes"].isna()]
        if not len(held) or not len(asked):
            return pd.DataFrame({"a": [], "b": [], "linked": []})
        x, q = (np.stack(side["v"].to_list()).astype(float) for side in (held, asked))
        codes, missed = np.frombuffer(b"".join(held["codes"]), np.uint8).reshape(len(x), -1), held["missed"].to_numpy()
        lists, at = np.unique(held["list"].to_numpy(int), return_inverse=True)
        home = asked["list"].to_numpy(int)
        near = probes(index, q / np.linalg.norm(q, axis=1, keepdims=True), home, lists, reach)
        inside = cells[home] == int(group["cell"].iloc[0])
        names = np.concatenate([held["key"].to_numpy(), asked["key"].to_numpy()])
        copies, k = np.concatenate([held["copies"].to_numpy(), asked["copies"].to_numpy()]), len(held)
        # A vector that is held and asks is one node.
        node = pd.factorize(pd.Series(names))[0]
        label, linked, links = np.arange(len(names)), np.zeros(len(names)), []
        for n, name in enumerate(lists):
            own, asks = np.flatnonzero(at == n), np.flatnonzero(near[:, n])
            for low in range(0, len(asks), 256):
                some = asks[low : low + 256]
                i, j = close_pairs(index, int(name), q[some], x[own], codes[own], missed[own], cosine)
                i, j = some[i], own[j]
                # In their own cell both of a pair ask; the greater key reports it.
                one = ~inside[i] | (names[j] < names[k + i])
                i, j = i[one], j[one]
                linked += np.bincount(node[k + i], copies[j], len(names)) + np.bincount(node[j], copies[k + i], len(names))
                links += joining(node[k + i], node[j], label)
        name = pd.Series(names).unique()
        some = np.flatnonzero(linked)
        counts = pd.DataFrame({"a": name[some], "b": None, "linked": linked[some].astype(np.int64)})
        joins = pd.DataFrame({"a": [name[a] for a, _ in links], "b": [name[b] for _, b in links], "linked": 0})
        return pd.concat([counts, joins]) if len(joins) else counts

    return held.union(asked).groupBy("cell", "x", "y").applyInPandas(run, "a binary, b binary, linked long")
