"""A Merkle manifest as a persistent tree whose versions share what they do not change.

Every row is a leaf. The leaves of a group are numbered in order and cut into aligned blocks of 2**bits leaves; a block is folded pairwise
to its top in one task, and the tops of a group's blocks are the leaves of the next round, until one node, the group's subroot,
is left. The subroots are the leaves of a last tree. A changed leaf is a version of its own: only its ancestors are copied, first those in
its block, beside the block's own nodes, then one a level along the path of the block's top, while all other nodes are those of the original.

Steps of a path are texts: `l` and the digest of a sibling on the left, `r` and that of one on the right, or empty for a node that is
hashed alone.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.tables import stored

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATHS = "key long, branch string, idx long, node string, path array<string>, folded string, copied array<string>, top string"


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Digest of the fields in order: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows (with a non-null column branch) with idx, their place in the branch from 0, and n, its size.

    Rows are dealt by ranges of branch and order, so a branch of any size is split; a place is the place in the range's own run plus the
    rows of the branch in the ranges before, of which there is one number a range and branch.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(parts, "branch", *order).sortWithinPartitions("branch", *order).withColumn("at", place)
    ranged = stored(ranged, label).withColumn("part", F.shiftrightunsigned("at", 33))
    runs = ranged.groupBy("branch", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("branch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("branch", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy("branch")).alias("n"))
    return ranged.join(runs, ["branch", "part"]).withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _fold_block(block: pa.Table, bits: int) -> pa.Table:
    """Paths and versions of one aligned block's leaves; the first leaf's row carries the block's top."""
    block = block.sort_by("idx")
    key, branch, idx, node, changed = (block.column(c).to_pylist() for c in ("key", "branch", "idx", "node", "changed"))
    level, count = node, block.column("n")[0].as_py()
    steps: list[list[str]] = []
    while count > 1 and len(steps) < bits:
        steps.append(["l" + level[i - 1] if i & 1 else "r" + level[i + 1] if i + 1 < len(level) else "" for i in range(len(level))])
        level = [_digest("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        count = -(-count // 2)
    paths, folded, copied = [], [], []
    for i, old in enumerate(node):
        path = [level_steps[i >> h] for h, level_steps in enumerate(steps)]
        now, new = changed[i] or old, []
        for step in path:
            now = _digest(step[1:] + now if step[:1] == "l" else now + step[1:])
            new.append(now)
        paths.append(path)
        folded.append(now)
        copied.append(new if changed[i] and changed[i] != old else [])  # an unchanged leaf's ancestors are the tree's own nodes
    tops = [level[0], *[None] * (len(node) - 1)]
    texts = pa.list_(pa.string())
    columns = [pa.array(key, pa.int64()), pa.array(branch), pa.array(idx, pa.int64()), pa.array(node), pa.array(paths, texts), pa.array(folded), pa.array(copied, texts), pa.array(tops, pa.string())]
    return pa.table(columns, ["key", "branch", "idx", "node", "path", "folded", "copied", "top"])


def _round(nodes: DataFrame, bits: int, label: str) -> DataFrame:
    nodes = nodes.select("key", "branch", "idx", "n", "node", "changed", F.shiftright("idx", bits).alias("block"))
    return stored(nodes.groupBy("branch", "block").applyInArrow(lambda block: _fold_block(block, bits), PATHS), label)


def climbed(leaves: DataFrame, bits: int, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trees over leaves (key, branch, idx, n, node, changed), one a branch.

    Returns the leaves' rows in their blocks, (branch, idx, above): the path above every block of leaves, and (branch, top).
    """
    rounds, sizes = [], leaves.select("branch", "n").distinct()
    nodes = leaves
    most = sizes.agg(F.max("n")).first()[0] or 0
    while True:
        rounds.append(_round(nodes, bits, f"{label}-{len(rounds)}"))
        most = -(-most // 2**bits)
        tops = rounds[-1].filter("top is not null").select("branch", F.shiftright("idx", bits).alias("idx"), F.col("top").alias("node"))
        if most <= 1:
            break
        step = 2 ** (bits * len(rounds))
        left = sizes.select("branch", F.expr(f"(n + {step} - 1) div {step}").alias("n"))
        nodes = tops.join(left, "branch").select(F.lit(None).cast("long").alias("key"), "branch", "idx", "n", "node", F.lit(None).cast("string").alias("changed"))
    above = tops.select("branch", "idx", F.array().cast("array<string>").alias("above"))
    for lower in reversed(rounds[1:]):
        here = lower.select("branch", "idx", F.shiftright("idx", bits).alias("block"), "path")
        above = here.join(above.withColumnRenamed("idx", "block"), ["branch", "block"]).select("branch", "idx", F.concat("path", "above").alias("above"))
    return rounds[0], above, tops.select("branch", F.col("node").alias("top"))


def _parent(node: Column, step: Column) -> Column:
    sibling = F.substring(step, 2, 64)
    return F.sha2(F.when(step.startswith("l"), F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)


def folded_up(node: Column, path: Column) -> Column:
    """The digest at the end of a path."""
    return F.aggregate(path, node, _parent)


def ancestors(node: Column, path: Column) -> Column:
    """The digests along a path, one a step."""
    return F.slice(F.aggregate(path, F.array(node), lambda have, step: F.concat(have, F.array(_parent(F.element_at(have, -1), step)))), F.lit(2), F.size(path))


def proof_hash(path: Column) -> Column:
    """Digest of a path's siblings, joined from the leaf up."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.substring(step, 2, 64))), 256)


def versions(docs: DataFrame, changed: dict[str, Column], where: Column, bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, copied, verified) of every row of docs.

    The leaves of a language ascend by doc_id, null first, rows of one id by digest. Where `where` holds, the row's version replaces the
    fields in `changed`; folded_root is the version's root, along the original siblings, and equals root where nothing was changed. path
    has the steps from leaf to root, copied the digests the version does not share (none for unchanged rows). Null and empty
    fields have digests of their own; a language of one row has its leaf as subroot. Equal rows are leaves each. An empty table has no rows.
    """
    fields = {name: F.col(name) for name in FIELDS}
    plain = leaf_hash(fields)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("branch"),
        plain.alias("node"),
        F.when(where, leaf_hash(fields | changed)).alias("changed"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = stored(rows, "merkle-leaves")
    leaves = numbered(rows, [F.col("key").asc_nulls_first(), F.col("node"), F.col("tie")], "merkle-order")
    blocks, above, subroots = climbed(stored(leaves, "merkle-numbered"), bits, "merkle-blocks")
    subroots = stored(subroots, "merkle-subroots")
    one = subroots.select(F.lit(None).cast("long").alias("key"), F.lit("").alias("branch"), F.col("top").alias("node"), F.lit(None).cast("string").alias("changed"), F.col("branch").alias("name"))
    ends = stored(numbered(one, [F.col("name")], "merkle-names"), "merkle-named")
    upper, upper_above, roots = climbed(ends.drop("name"), bits, "merkle-upper")
    root = roots.first()
    last = upper.select("idx", "path", F.shiftright("idx", bits).alias("block")).join(upper_above.select(F.col("idx").alias("block"), "above"), "block")
    last = ends.select("idx", F.col("name").alias("branch"), F.col("node").alias("subroot")).join(last, "idx").select("branch", "subroot", F.concat("path", "above").alias("to_root"))
    paths = above.join(last, "branch").select("branch", F.col("idx").alias("block"), "subroot", F.concat("above", "to_root").alias("above"))
    out = blocks.withColumn("block", F.shiftright("idx", bits)).join(paths, ["branch", "block"])
    out = out.withColumn("root", F.lit(root.top if root else None).cast("string")).withColumn("folded_root", folded_up(F.col("folded"), F.col("above")))
    shared = F.array().cast("array<string>")
    copied = F.when(F.col("folded_root") == F.col("root"), shared).otherwise(F.concat("copied", ancestors(F.col("folded"), F.col("above"))))
    return out.select(
        F.col("key").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", F.concat("path", "above").alias("path"),
        "folded_root", copied.alias("copied"), (F.col("folded_root") == F.col("root")).alias("verified"),
    )
