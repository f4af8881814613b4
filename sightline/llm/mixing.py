"""Mixing sources to target weights, in DataFrame functions only.

Documents of a source are dealt by a hash into about sqrt(documents) blocks. The target says how many
whole passes over its blocks a source gets and how many words of one more pass; that pass takes blocks in permuted order, and
of the block in which the target falls the documents, again in permuted order, up to it. Words still missing are filled in rounds from
the unchosen documents of all blocks that the pass has not taken whole, each round leaving out those larger than what is missing. The blocks taken are the
source's quota. A binary tree then splits the quotas among the output shards: the two halves of a node get equal numbers
of blocks, and how many of each source go left is a multivariate hypergeometric draw (one source after another, each
conditioned on the ones before). Each shard takes disjoint runs of each source's permuted blocks
and is put in random order by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.tables import packed, stored

WEIGHTS = (1.0, 2.0, 3.0)
REPEATS = 3
SHARD_WORDS, MOST_LEVELS = 1 << 20, 14


def words(text: str = "text") -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def enough_levels(sizes: DataFrame) -> int:
    """Depth of a splitting tree whose shards have about SHARD_WORDS words of the given sizes."""
    total = sizes.agg(F.sum("size")).first()[0] or 0
    return min(MOST_LEVELS, max(2, (int(total) // SHARD_WORDS).bit_length()))


def _chance(*parts: Column) -> Column:
    """A repeatable value in [0, 1)."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, n_docs, source_size, target) from (source, size): shares of the total by cycling weights, capped.

    Sources stand in code-point order, null last. A target stops at `repeats` times the source's size; the excess goes to
    the others by weight. In closed form: sources in order of size per weight; the capped ones are those before
    the first whose share of what the capped leave is below its cap.
    """
    rows = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place - 1) % len(weights) + 1))
    cap = F.col("source_size") * float(repeats)
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.select(
        "source", "n_docs", "source_size", "weight", cap.alias("cap"),
        F.coalesce(F.sum(cap).over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
        F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("all_weight"),
    )
    level = (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    rows = rows.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    rows = rows.withColumn("shared", F.min(F.when(F.col("open"), F.struct(F.col("weight_before").alias("at"), F.col("level")))).over(everything)["level"])
    return rows.select("source", "n_docs", "source_size", F.coalesce(F.least(F.col("cap"), F.col("shared") * F.col("weight")), F.col("cap")).alias("target"))


def _left_blocks(seed: int, level: int) -> Column:
    """How many blocks of each source of a node (own: array of source_key and quota) its left half gets."""

    def draw(state: Column, item: Column) -> Column:
        # Blocks of one source, one after another: each goes left with the chance of the places left over the blocks left.
        def block(s: Column, i: Column) -> Column:
            one = (_chance(F.lit(seed), F.lit(level), F.col("node"), item["source_key"], i) * s["blocks"] < s["places"]).cast("long")
            return F.struct((s["places"] - one).alias("places"), (s["blocks"] - 1).alias("blocks"), (s["left"] + one).alias("left"))

        start = F.struct(state["places"].alias("places"), state["blocks"].alias("blocks"), F.lit(0).cast("long").alias("left"))
        done = F.aggregate(F.slice(F.sequence(F.lit(0).cast("long"), item["quota"]), F.lit(2), item["quota"].cast("int") + 1), start, block)
        return F.struct(done["places"].alias("places"), done["blocks"].alias("blocks"), F.concat(state["left"], F.array(done["left"])).alias("left"))

    total = F.aggregate("own", F.lit(0).cast("long"), lambda x, item: x + item["quota"])
    places = F.floor((total + F.col("node") % 2) / 2).cast("long")
    start = F.struct(places.alias("places"), total.alias("blocks"), F.expr("cast(array() as array<bigint>)").alias("left"))
    return F.aggregate("own", start, draw)["left"]


def _gathered(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("source_key", "quota"))).alias("own"))


def _split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, source_key, taken, first) from (source_key, quota): the leaves of the splitting tree, `first` the source's blocks in earlier shards."""
    node = _gathered(quotas.withColumn("node", F.lit(0)))
    for level in range(levels):
        node = node.withColumn("left", _left_blocks(seed, level))
        sides = F.zip_with("own", "left", lambda item, n: F.struct(item["source_key"].alias("source_key"), F.array(n, item["quota"] - n).alias("sides")))
        node = node.select("node", F.explode(sides).alias("item")).select("node", "item.source_key", F.posexplode("item.sides").alias("side", "quota"))
        node = stored(_gathered(node.withColumn("node", F.col("node") * 2 + F.col("side"))), "mix-tree")
    leaves = node.select(F.col("node").alias("shard"), F.explode("own").alias("item")).select("shard", "item.source_key", F.col("item.quota").alias("taken"))
    earlier = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("taken").over(earlier), F.lit(0))).filter("taken > 0")


def _filled(pool: DataFrame, short: DataFrame, seed: int) -> tuple[DataFrame | None, DataFrame]:
    """The rows of pool (source_key, nth, row, doc_id, digest, size) that fill what is short (source_key, short), and what is then still short.

    Each round leaves out documents larger than what is missing and takes the others, block by block and in permuted order
    inside the block in which the missing words run out, until none fits.
    """
    filled = None
    inner = Window.partitionBy("source_key", "nth").orderBy(F.xxhash64("doc_id", F.lit(seed + 3)), "doc_id", "digest", "row")
    outer = Window.partitionBy("source_key").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        fits = stored(pool.join(short, "source_key").filter(F.col("size") <= F.col("short")), "mix-fits")
        if fits.isEmpty():
            return filled, short
        blocks = fits.groupBy("source_key", "nth").agg(F.sum("size").alias("own")).withColumn("until", F.sum("own").over(outer))
        rows = fits.join(stored(blocks, "mix-fit-blocks"), ["source_key", "nth"])
        room = F.col("short") - F.col("until") + F.col("own")
        whole = F.col("until") <= F.col("short")
        cut = rows.filter(~whole & (room > 0)).withColumn("take", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)) <= room)
        rows = cut.unionByName(rows.filter(whole | (room <= 0)).withColumn("take", whole))
        rows = stored(rows.select(*pool.columns, "take"), "mix-filled")
        taken, pool = rows.filter("take").drop("take"), rows.filter("not take").drop("take")
        filled = taken if filled is None else filled.union(taken)
        less = taken.groupBy("source_key").agg(F.sum("size").alias("less"))
        short = stored(short.join(less, "source_key", "left").select("source_key", (F.col("short") - F.coalesce("less", F.lit(0))).alias("short")), "mix-still-short")


def draw_plan(docs: DataFrame, levels: int | None = None, seed: int = 7, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, source, size, digest, source_size, target, places) of every row; places: array of struct(copy, shard), one per time it is taken.

    2**levels output shards, by default enough for about SHARD_WORDS words each, 2**MOST_LEVELS at most. Texts of null size 0 belong to their source and cost nothing. Null ids are one id; repeated
    rows and ties are dealt alike and each counts. An empty table gives no row.
    """
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words().alias("size"), F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row")), "mix-sizes")
    if levels is None:
        levels = enough_levels(sizes)
    targets = source_targets(sizes, weights, repeats)
    # Null and the empty string stay apart in one key that is never null.
    targets = targets.withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats))).otherwise(0).cast("int")
    targets = targets.withColumn("passes", passes).withColumn("rest", F.greatest(F.lit(0.0), F.when(F.col("passes") < repeats, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0)))
    targets = stored(targets.withColumn("n_blocks", F.ceil(F.sqrt("n_docs")).cast("long")), "mix-targets")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = sizes.withColumn("source_key", key).join(targets.select("source_key", "n_blocks"), "source_key")
    rows = stored(rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), "n_blocks")).drop("n_blocks"), "mix-rows")

    blocks = rows.groupBy("source_key", "block").agg(F.sum("size").alias("words")).join(targets, "source_key")
    order = Window.partitionBy("source_key").orderBy(F.xxhash64("block", F.lit(seed + 1)), "block")
    blocks = blocks.withColumn("nth", F.row_number().over(order)).withColumn("until", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    room = F.col("rest") - (F.col("until") - F.col("words"))  # words of the last pass that this block may give
    blocks = blocks.withColumn("room", F.greatest(F.lit(0.0), F.least(room, F.col("words").cast("double"))))
    blocks = stored(blocks.withColumn("copies", F.col("passes") + (F.col("room") > 0).cast("int")), "mix-blocks")

    quotas = blocks.groupBy("source_key").agg(F.sum("copies").cast("long").alias("quota"))
    shards = stored(_split_quotas(quotas, levels, seed), "mix-shards")
    slots = shards.select("source_key", "shard", F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("taken"))).alias("slot"))
    drawn = blocks.filter("copies > 0").select("source_key", "block", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    deal = Window.partitionBy("source_key").orderBy(F.xxhash64("block", "copy", F.lit(seed + 2)), "block", "copy")
    drawn = drawn.withColumn("slot", F.row_number().over(deal).cast("long")).join(slots, ["source_key", "slot"])
    placed = drawn.groupBy("source_key", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("places"))
    plan = stored(blocks.join(placed, ["source_key", "block"], "left").select("source_key", "block", "nth", "passes", "rest", "words", "room", "source_size", "target", "places"), "mix-plan")

    rows = rows.join(plan, ["source_key", "block"])
    # Only in the block where the target falls is a running sum needed.
    cut = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    rows = stored(rows, "mix-dealt")
    inner = Window.partitionBy("source_key", "block").orderBy(F.xxhash64("doc_id", F.lit(seed + 3)), "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.filter(cut).withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    inside = inside.withColumn("extra", (F.col("before") + F.col("size") <= F.col("room")) & (F.col("size") > 0)).drop("before")
    outside = rows.filter(~cut).withColumn("extra", F.col("room") > 0)
    both = stored(inside.unionByName(outside), "mix-chosen")
    # What is left up to the target is filled from the unchosen documents of this block and the next ones.
    cut_at = F.when((F.col("room") > 0) & (F.col("room") < F.col("words")), F.struct(F.col("nth"), F.element_at("places", -1)["shard"].alias("shard")))
    last = both.groupBy("source_key").agg(
        F.max("rest").alias("rest"), F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0)).alias("chosen"), F.max(cut_at).alias("cut"),
    )
    last = last.select("source_key", (F.col("rest") - F.col("chosen")).alias("short"), F.coalesce("cut.nth", F.lit(1)).alias("cut_nth"), F.coalesce("cut.shard", F.lit(0)).alias("cut_shard"))
    last = stored(last, "mix-short")
    pool = both.filter(~F.col("extra") & (F.col("size") > 0) & (F.col("passes") < repeats)).select("source_key", "nth", "row", "doc_id", "digest", "size")
    filled, short = _filled(pool, last.select("source_key", "short"), seed)
    # Blocks that fill go to one shard after another, from that of the cut block on.
    last = stored(last.drop("short").join(short, "source_key"), "mix-left")
    at = F.pmod(F.col("cut_shard") + F.col("nth") - F.col("cut_nth"), F.lit(1 << levels)).cast("int")
    both = both.join(last, "source_key").withColumn("fill_shard", at)
    if filled is None:
        both = both.withColumn("filled", F.lit(False))
    else:
        both = both.join(filled.select("row", F.lit(True).alias("filled")), "row", "left").withColumn("filled", F.coalesce("filled", F.lit(False)))
    both = stored(both, "mix-both")
    # Then the one unchosen document whose size comes closest, if that is nearer than none.
    away = F.abs(F.col("size") - F.col("short"))
    fill = both.filter(~F.col("extra") & ~F.col("filled") & (F.col("size") > 0) & (F.col("passes") < repeats)).filter(away < F.col("short"))
    fill = stored(fill.groupBy("source_key").agg(F.min_by("row", F.struct(away, "doc_id", "row")).alias("row")), "mix-fill")
    both = both.join(fill.withColumnRenamed("row", "fill_row"), "source_key", "left")
    none = F.expr("cast(array() as array<struct<copy:int,shard:int>>)")
    taken = F.coalesce(F.filter("places", lambda p: (p["copy"] <= F.col("passes")) | F.col("extra")), none)
    more = F.array(F.struct((F.col("passes") + 1).alias("copy"), F.col("fill_shard").alias("shard")))
    taken = F.when(F.col("filled") | F.coalesce(F.col("row") == F.col("fill_row"), F.lit(False)), F.concat(taken, more)).otherwise(taken)
    return both.select("doc_id", "source", "size", "digest", "source_size", "target", taken.alias("places"))


def mix(docs: DataFrame, levels: int | None = None, seed: int = 7, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """docs as mixed: each row as often as it is taken, dealt to 2**levels shards and in random order inside each; columns unchanged, whatever their names.

    Of rows that agree in id, source and text, one stands for all, as often as they are taken together.
    """
    if levels is None:
        levels = enough_levels(docs.select(words().alias("size")))
    plan = draw_plan(docs, levels, seed, weights, repeats)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    plan = plan.groupBy(F.col("doc_id").alias("mix_id"), key.alias("mix_key"), F.col("digest").alias("mix_digest")).agg(
        F.array_sort(F.flatten(F.collect_list("places"))).alias("mix_places"), F.count(F.lit(1)).alias("mix_rows")
    )
    plan = stored(plan.filter(F.size("mix_places") > 0), "mix-places")
    own_key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    own = packed(docs, own_id=F.col("doc_id").cast("long"), own_key=own_key, own_digest=F.xxhash64("text"))
    same = own["own_id"].eqNullSafe(plan["mix_id"]) & (own["own_key"] == plan["mix_key"]) & (own["own_digest"] == plan["mix_digest"])
    # Rows that repeat share their places, so one of them is written for each place.
    rows = own.join(plan.filter("mix_rows = 1"), same).unionByName(own.join(plan.filter("mix_rows > 1"), same).dropDuplicates(["own_id", "own_key", "own_digest"]))
    rows = rows.withColumn("mix_place", F.explode("mix_places"))
    rows = rows.withColumn("mix_turn", F.xxhash64("row.doc_id", "mix_place", F.lit(seed + 4)))
    rows = rows.repartitionById(1 << levels, F.col("mix_place.shard")).sortWithinPartitions("mix_turn", "row.doc_id")
    return rows.select("row.*")
