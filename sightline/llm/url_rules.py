"""URL rules by a sort-merge range join, in DataFrame functions only.

The host of a url, its labels reversed and each ended by a dot, is its canonical key: a rule for a host and all
its subdomains then holds for the keys that start with the rule's key, one interval of the sorted keys.
Intervals are nested or disjoint. Distinct hosts and the two ends of every interval are sorted together
by range; at each end the stack of rules active from there on is known from the rules alone, so the sweep carries
the last stack forward, first from partition to partition (one row each) and then row by row. Each
page takes from its host's stack the longest rule whose path starts its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.llm.tables import stored, unused

DEFAULT = "allow"
# The rules of the query's contract, host, path and verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, with A-Z in lower case; empty for null or without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(host, path, verdict) of stated rules."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, active) for distinct hosts: the rules of the host and of all hosts above it, as array of struct(path, verdict, host)."""
    own = rules.filter("host is not null and path is not null and verdict is not null")
    own = own.groupBy("host").agg(F.sort_array(F.collect_set(F.struct("path", "verdict", "host"))).alias("own"))
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    chain = own.select(F.col("host").alias("low"), F.explode(above).alias("host")).join(own, "host")
    stacks = chain.groupBy("low").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("stack"))
    # Where an interval ends, the stack without the rules of the ending host is active again.
    ends = stacks.select(host_key(F.col("low")).alias("key"), "low", "stack")
    after = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    events = ends.select("key", F.lit(0).alias("kind"), "stack", F.lit(None).cast("string").alias("host")).unionByName(
        ends.select(after.alias("key"), F.lit(0).alias("kind"), F.filter("stack", lambda r: r["host"] != F.col("low")).alias("stack"), F.lit(None).cast("string").alias("host"))
    )
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast(events.schema["stack"].dataType).alias("stack"), "host")
    n = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(events.unionByName(points).repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()), "url-sweep")
    last = dealt.filter("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).join(last, "part", "left")
    carried = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(parts.select("part", F.last("stack", True).over(carried).alias("first")), "url-first")
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("seen", F.last("stack", True).over(so_far)).filter("kind = 1").join(first, "part")
    return swept.select("host", F.coalesce("seen", "first").alias("active"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """pages with host, path, rule and verdict.

    The longest rule that fits wins (by the length of host and path together, then of the host; of rules that differ in
    the verdict only, block); `rule` is its host and path. Where none fits rule is null and the verdict is `default`. Null urls
    and urls without :// have an empty host and path. Repeated rows and other columns are kept; columns of the four
    names are replaced. Rules with a null in any column are ignored; without rules all pages get the default.
    """
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    active = stored(active_rules(rows.select("host").distinct(), rules), "url-active")
    at, found, best = (unused(rows, name) for name in ("active_host", "active_rules", "best_rule"))
    rows = rows.join(active.withColumnsRenamed({"host": at, "active": found}), F.col("host") == F.col(at), "left")
    fits = F.filter(found, lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(fits, lambda r: F.struct((F.length(r["host"]) + F.length(r["path"])).alias("n"), F.length(r["host"]).alias("h"), r["verdict"].alias("verdict"), F.concat(r["host"], r["path"]).alias("rule")))
    rows = rows.withColumn(best, F.array_max(ranked))
    rows = rows.withColumns({"rule": F.col(best)["rule"], "verdict": F.coalesce(F.col(best)["verdict"], F.lit(default))})
    return rows.drop(at, found, best)
