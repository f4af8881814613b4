"""Row-shape operators: dense grains, first-per-key, idempotent merges, tagged differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 32


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds (or replaces) columns that are evaluated once per row.

    A one-element ``inline`` keeps the optimizer from copying the expressions into every later
    filter and projection that mentions them; payload expressions would multiply otherwise.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def dense_grain(
    rows: DataFrame, registry: DataFrame, key: str | Sequence[str], spread: int = SPREAD
) -> DataFrame:
    """Every row combined with every registry entry, as an equi-join on a spread number.

    The rows are spread by a hash of their key over ``spread`` groups and each registry entry is
    copied once per group. While the registry is below the broadcast threshold Spark broadcasts
    it and no row moves; above it the join shuffles into ``spread`` even groups.
    """
    keys = [key] if isinstance(key, str) else list(key)
    left = rows.withColumn("_spread", F.pmod(F.xxhash64(*keys), F.lit(spread)).cast("int"))
    right = registry.withColumn("_spread", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return left.join(right, "_spread").drop("_spread")


def growing(df: DataFrame) -> DataFrame:
    """A side of a by-key join that grows with the input: merged, never sent whole through the driver.

    Spark sizes a narrow cut of a stored frame by its share of the column widths, and takes a VARIANT for 2,048 bytes, so keys of millions
    of rows pass for a few MB and would be broadcast.
    """
    return df.hint("merge")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under an explicit order.

    The rank filter lets Spark keep one row per key and task before the shuffle, so a hot key
    never gathers in one place. Order columns must break every tie.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per(df: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    return first_per(df, keys, [F.desc_nulls_last(time), F.asc(tie)])


def insert_or_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rows of the batch to append: first per key, keys the target already has left out."""
    fresh = first_per(batch, keys, order)
    return fresh.join(target.select(*keys).distinct(), list(keys), "left_anti")


def replace_by(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after all rows of every key in the batch were replaced by the batch's rows."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch)


def two_way_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_tag: str, right_tag: str
) -> DataFrame:
    """Keys found on one side only, tagged with the side's problem name."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return (
        a.join(b, list(keys), "left_anti").withColumn("problem", F.lit(left_tag))
        .unionByName(b.join(a, list(keys), "left_anti").withColumn("problem", F.lit(right_tag)))
    )


def union_all(frames: Sequence[DataFrame], fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed by comparing the JSON form of the whole row."""
    return (
        df.withColumn("payload_json", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
        .dropDuplicates(["payload_json"])
    )


def preferred_first(tasks: DataFrame, ready: DataFrame, key: str) -> DataFrame:
    """All tasks with a ``ready`` flag, ready ones ordered first."""
    flags = ready.select(key).distinct().withColumn("_ready", F.lit(1))
    return (
        tasks.join(flags, key, "left")
        .withColumn("ready", F.coalesce("_ready", F.lit(0)))
        .drop("_ready")
        .orderBy(F.desc("ready"), F.asc(key))
    )
