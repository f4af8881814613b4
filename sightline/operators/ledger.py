"""Collection ledger as table analytics: plans, pending work, manifests, spend, retries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.cols import all_of, case
from sightline.operators.shape import first_per
from sightline.session import stored

ACCEPTED_STATES = ("submitted_pending_result", "completed")
PENDING_STATE = "submitted_pending_result"
SERP_ENGINES = ("google", "bing", "yahoo", "baidu")


def plan_to_send(plan: DataFrame, history: DataFrame, key: str = "deduplication_key") -> DataFrame:
    """Planned requests minus verified successes of the same key; repeats in the plan go once."""
    done = history.filter("verified_success").select(key).distinct()
    return first_per(plan, [key], [F.asc("position")]).join(done, key, "left_anti")


def accepted_assignments(requests: DataFrame, responses: DataFrame, category: str, window: str, provider: str) -> DataFrame:
    """Instrument-target pairs already accepted (and paid) in a collection window."""
    rows = requests.filter(
        (F.col("source_category") == category) & (F.col("provider") == provider)
        & (F.col("collection_window") == window) & F.col("request_status").isin(*ACCEPTED_STATES)
    )
    if category == "llm":
        rows = rows.filter(F.col("request_hash").isNotNull())
    paid = responses.filter(F.col("task_id").isNotNull() & (F.col("actual_cost") > 0)).select("request_id")
    return rows.join(paid, "request_id", "left_semi").select("query_id", "search_target_id").distinct()


def pending_tasks(
    requests: DataFrame, responses: DataFrame, category: str, provider: str, sources: Sequence[str]
) -> DataFrame:
    """Submitted tasks awaiting their result; search engines compare case-insensitively."""
    source = F.lower("search_engine") if category == "serp" else F.col("platform")
    rows = requests.filter(
        (F.col("request_status") == PENDING_STATE) & (F.col("source_category") == category)
        & (F.col("provider") == provider) & source.isin(list(sources))
    )
    tasks = responses.filter(F.col("task_id").isNotNull()).select("request_id", "task_id")
    return rows.join(tasks, "request_id").select(
        "request_id", "task_id", "query_id", "search_target_id", "collection_window", source.alias("source")
    )


def assignment_table(
    assignments: DataFrame, sources: DataFrame, targets: DataFrame, source: str, target: str
) -> DataFrame:
    """Active assignments resolved against active instruments and targets."""
    s = sources.filter("active").drop("active")
    t = targets.filter("active").drop("active")
    return assignments.filter("active").drop("active").join(s, source).join(t, target)


def assignment_coverage(configured: DataFrame, requests: DataFrame, platform: str = "platform") -> DataFrame:
    """Configured, submitted and retrieved assignments per platform."""
    state = requests.groupBy("query_id", "search_target_id").agg(
        F.bool_or(F.col("request_status").isin(*ACCEPTED_STATES)).alias("_submitted"),
        F.bool_or(F.col("request_status") == "completed").alias("_retrieved"),
    )
    rows = configured.join(state, ["query_id", "search_target_id"], "left")
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.groupBy(platform).agg(
        F.count("*").alias("configured"), yes("_submitted").alias("submitted"), yes("_retrieved").alias("retrieved"),
    ).withColumn("missing", F.col("configured") - F.col("submitted"))


def run_manifests(attempts: DataFrame) -> DataFrame:
    """Outcome counts, cost sums and status per run."""
    ok, bad = F.count_if(F.col("state") == "success"), F.count_if(F.col("state") == "failed")
    rows = attempts.groupBy("run_id").agg(
        F.count("*").alias("attempts"), ok.alias("successes"), bad.alias("failures"),
        F.coalesce(F.sum("estimated_cents"), F.lit(0)).alias("estimated_cents"),
        F.coalesce(F.sum("actual_cents"), F.lit(0)).alias("actual_cents"),
    )
    status = case([
        ((F.col("successes") > 0) & (F.col("failures") > 0), "partial_success"),
        (F.col("successes") > 0, "success"),
    ], "failed")
    return rows.withColumn("status", status)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Running total per key in the order of any columns, however many rows a key has.

    Rows are dealt by ranges of key and order, so a key of any size is split into runs. A row's total is the sum inside its run plus those of
    the key's runs in the ranges before, of which there is one number a range and key. Rows equal in keys and order follow each other
    in any order; null keys are a key of their own.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = [*keys, *order]
    ranged = df.repartitionByRange(parts, *along).sortWithinPartitions(*along).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, "running-sum").withColumn("_part", F.shiftrightunsigned("_at", 33))
    totals = ranged.groupBy("_part", *keys).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col("l._part") == F.col("r._part"), *[F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]]
    joined = ranged.withColumn("_inside", F.sum(value).over(inside)).alias("l").join(offsets.alias("r"), all_of(*same))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._inside") + F.col("r._offset")).alias(out))


def spend_ledger(costs: DataFrame, caps: Mapping[str, int], order: Sequence[str] = ("position",)) -> DataFrame:
    """Spend after every request per capped dimension, with a flag once the cap is exceeded.

    ``caps`` maps a column (run_id, target_id, engine, platform, day) to its cap in cents. Reports
    breaches; requests are not refused here.
    """
    dims = list(caps)
    kept = [c for c in order if c != "request_id"]
    text = costs.select("request_id", *kept, "cents", *[F.col(d).cast("string").alias(d) for d in dims])
    long = text.unpivot(["request_id", *kept, "cents"], dims, "dimension", "member").filter(F.col("member").isNotNull())
    running = running_sum(long, ["dimension", "member"], order, "cents", "spent_cents")
    cap = case([(F.col("dimension") == d, F.lit(c)) for d, c in caps.items()], F.lit(None).cast("int"))
    return running.withColumn("cap_cents", cap).withColumn("breached", F.col("spent_cents") > F.col("cap_cents"))


def spend_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("dimension", "member").agg(
        F.sum("cents").alias("spent_cents"), F.count_if("breached").alias("breached_requests"),
    )


# How failures of a request are classified.
NO_RETRY_CODES = (401, 402, 403)
RETRY_CODES = (500, 503)
THROTTLED_CODE = 429


def retry_decision(code: Column, timeout_after_post: Column, retry_supported: Column) -> Column:
    return case([
        (F.coalesce(timeout_after_post, F.lit(False)), "outcome_unknown"),
        (code.isin(*NO_RETRY_CODES), "no_retry"),
        ((code == THROTTLED_CODE) & F.coalesce(retry_supported, F.lit(False)), "retry"),
        (code.isin(*RETRY_CODES), "retry"),
    ], "no_retry")


def status_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Row counts per status combination, null statuses kept."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))
