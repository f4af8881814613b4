"""Data-quality rules: every function returns the violating rows, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.cols import all_of, any_of, case, flag, rate
from sightline.operators.shape import union_all
from sightline.schemas import AVAILABLE



def _tagged(df: DataFrame, rule: str, key: str | Column) -> DataFrame:
    column = F.col(key) if isinstance(key, str) else key
    return df.select(F.lit(rule).alias("rule"), column.cast("string").alias("failure_id"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = df.filter(all_of(*[F.col(k).isNotNull() for k in keys]))
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def nulls(df: DataFrame, column: str, key: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(key)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def outside_vocabulary(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Count per value that is not in the vocabulary (nulls are a matter of ``nulls``)."""
    bad = df.filter(~F.col(column).isin(list(values)))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def freshness(
    df: DataFrame, time: str, as_of: Column, warn_days: int = 7, error_days: int = 30
) -> DataFrame:
    """Age in days of the newest row against a given date, with its verdict."""
    newest = df.agg(F.max(time).alias("newest"))
    age = F.date_diff(F.to_date(as_of), F.to_date("newest"))
    return newest.select(
        "newest", age.alias("age_days"),
        case([(age.isNull() | (age > error_days), "error"), (age > warn_days, "warn")], "pass").alias("verdict"),
    )


def coverage_invariants(coverage: DataFrame, items: DataFrame, results: DataFrame) -> DataFrame:
    """Counts agree with coverage, ranks with kinds, parse rates with item counts."""
    status, seen, whole = F.col("coverage_status"), F.col("observed_count"), F.col("exhaustive_count")
    bad_coverage = coverage.filter(any_of(
        F.coalesce(seen < 0, F.lit(False)), F.coalesce(whole < 0, F.lit(False)),
        (status != "complete") & whole.isNotNull(),
        (status == "complete") & ~whole.eqNullSafe(seen),
    ))
    organic = F.col("item_kind") == "organic"
    bad_items = items.filter(any_of(
        ~organic & F.col("organic_rank").isNotNull(),
        organic & ~F.col("organic_rank").eqNullSafe(F.col("rank_group")),
        ~F.col("page_position").eqNullSafe(F.col("rank_absolute")),
    ))
    bad_results = results.filter(
        ~F.col("parse_success_rate").between(0, 1)
        | (F.col("parsed_top_level_item_count") > F.col("top_level_item_count"))
    )
    return union_all([
        _tagged(bad_coverage, "feature_coverage", "feature_id"),
        _tagged(bad_items, "item_ranks", "item_id"),
        _tagged(bad_results, "result_counts", "result_id"),
    ])


SUMMARY_COUNTS = (
    "organic_count", "product_card_count", "answer_block_count", "image_count", "citation_count",
    "distinct_brand_count",
)


def summary_invariants(summaries: DataFrame) -> DataFrame:
    """Incomplete responses carry no counts, and no count is negative."""
    counts = [F.col(c) for c in (*SUMMARY_COUNTS, "atomic_item_count")]
    incomplete = (F.col("evidence_coverage_status") != "complete") & any_of(*[c.isNotNull() for c in counts])
    unapproved = (F.col("brand_coverage_status") == "no_approved_registry") & F.col("distinct_brand_count").isNotNull()
    negative = any_of(*[F.coalesce(F.col(c) < 0, F.lit(False)) for c in SUMMARY_COUNTS])
    return _tagged(summaries.filter(incomplete | unapproved | negative), "response_counts", "observation_id")


def denominator_rules(serp: DataFrame) -> DataFrame:
    return union_all([
        _tagged(serp.filter((F.col("availability_status") == AVAILABLE) & (F.col("denominator") <= 0)), "available_without_denominator", "metric_id"),
        _tagged(serp.filter(F.col("numerator") > F.col("denominator")), "numerator_above_denominator", "metric_id"),
    ])


def presence_gap_rule(metrics: DataFrame) -> DataFrame:
    """Available comparisons are matched and their gap is the difference of the presence flags."""
    gap = flag(F.col("llm_metric_value") > 0) - flag(F.col("serp_numerator") > 0)
    value = F.col("metric_value")
    bad = any_of(
        F.col("comparison_eligibility") != "matched_context", value.isNull(),
        ~value.isin(-1, 0, 1), value != gap,
    )
    return _tagged(metrics.filter((F.col("availability_status") == AVAILABLE) & F.coalesce(bad, F.lit(True))), "presence_gap", "metric_id")


CONTEXT = ("language_code", "location_code", "collection_window")


def matched_context_rule(metrics: DataFrame, serp: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows called matched really have both observations and one equal, known context."""
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            F.col("observation_id").alias(f"{prefix}_observation_id"), "brand_id",
            F.lit(True).alias(f"_{prefix}"), *[F.col(c).alias(f"{prefix}_{c}") for c in CONTEXT],
        )

    rows = (
        metrics.filter("comparison_eligibility = 'matched_context'")
        .select("metric_id", "brand_id", "serp_observation_id", "llm_observation_id")
        .join(side(serp, "serp"), ["serp_observation_id", "brand_id"], "left")
        .join(side(answers, "llm"), ["llm_observation_id", "brand_id"], "left")
    )
    differs = [
        F.col(f"serp_{c}").isNull() | F.col(f"llm_{c}").isNull() | (F.col(f"serp_{c}") != F.col(f"llm_{c}"))
        for c in CONTEXT
    ]
    return _tagged(rows.filter(any_of(F.col("_serp").isNull(), F.col("_llm").isNull(), *differs)), "matched_context", "metric_id")


LOCALE = ("language_code", "location_code", "raw_language_code", "raw_location_code")


def locale_lineage_rule(gold: DataFrame, silver: DataFrame, rule: str) -> DataFrame:
    """Locale columns are carried unchanged (null-safe) from observations to metrics."""
    source = silver.select("observation_id", *[F.col(c).alias(f"_{c}") for c in LOCALE])
    rows = gold.join(source, "observation_id")
    return _tagged(rows.filter(any_of(*[~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LOCALE])), rule, "metric_id")


def missing_is_not_absence(serp: DataFrame, comparisons: DataFrame) -> DataFrame:
    return union_all([
        _tagged(serp.filter("availability_status = 'available' and numerator = 0 and metric_value is null"), "absence_without_value", "metric_id"),
        _tagged(comparisons.filter("availability_status = 'not_collected' and metric_value is not null"), "uncollected_with_value", "metric_id"),
    ])


def unavailable_has_no_value(frames: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([
        _tagged(f.filter("availability_status <> 'available' and metric_value is not null"), f"{name}_unavailable_value", "metric_id")
        for name, f in frames.items()
    ])


def current_pointer_rule(pointer: DataFrame, releases: DataFrame) -> DataFrame:
    """The current slot names a completed release."""
    status = releases.select("release_id", "status")
    rows = pointer.filter("slot = 'current'").join(status, "release_id", "left")
    return _tagged(rows.filter(F.col("status").isNull() | (F.col("status") != "completed")), "incomplete_current_release", "release_id")


def response_validity_rule(responses: DataFrame) -> DataFrame:
    return _tagged(nulls(responses, "response_valid", "response_id"), "response_validity_unknown", "response_id")


# ---------------------------------------------------------------------------
# Registries
# ---------------------------------------------------------------------------

# Patterns of registry fields.
IDENTIFIER = r"^[a-z0-9][a-z0-9-]{0,62}$"
MARKET = r"^[A-Za-z0-9-]{2,16}$"
LANGUAGE = r"^[A-Za-z]{2,8}$"
LANGUAGE_TAG = r"^[A-Za-z]{2,8}(?:-[A-Za-z0-9]{2,8})*$"
DOMAIN = r"^[A-Za-z0-9.-]+\.[A-Za-z]{2,63}$"
CODE = r"^[A-Za-z0-9_-]{1,32}$"
RETRIEVAL_METHODS = ("TO_BE_VERIFIED", "standard", "live")
MODEL_NAMES = ("TO_BE_VERIFIED", "chat_gpt", "gemini")
MAPPING_SCOPE = "matched_locale_window"


def overlapping_windows(brands: DataFrame) -> DataFrame:
    """Brands whose ownership window overlaps an earlier one of the same name, market, language.

    A running maximum of the end dates finds every overlapping row without pairing rows: a row
    overlaps an earlier one exactly when it starts no later than the latest end before it.
    """
    far = F.lit("9999-12-31").cast("date")
    rows = brands.withColumn("_name", F.lower("canonical_name")).withColumn(
        "_end", F.coalesce(F.col("effective_end_date").cast("date"), far)
    )
    window = (
        Window.partitionBy("_name", "market", "language")
        .orderBy("effective_start_date", "_end", "brand_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = rows.withColumn("_latest_end", F.max("_end").over(window))
    return seen.filter(F.col("effective_start_date") <= F.col("_latest_end")).drop("_name", "_end", "_latest_end")


def row_contracts(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (rule, key) whose condition is not true."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]))
    return df.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("failure_id"))


def matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def brand_rules() -> dict[str, Column]:
    return {
        "brand_id": matches("brand_id", IDENTIFIER), "canonical_name": F.length("canonical_name") > 0,
        "ownership_type": F.length("ownership_type") > 0, "market": matches("market", MARKET),
        "language": matches("language", LANGUAGE),
        "date_range": F.col("effective_end_date").isNull() | (F.col("effective_end_date") >= F.col("effective_start_date")),
    }


def search_target_rules() -> dict[str, Column]:
    return {
        "search_target_id": matches("search_target_id", IDENTIFIER),
        "retrieval_method": F.col("retrieval_method").isin(*RETRIEVAL_METHODS),
        "location_code": matches("location_code", CODE),
        "language_code": matches("language_code", LANGUAGE_TAG),
        "depth": F.col("depth") > 0,
        "provider_differs": F.lower("provider") != F.lower("search_engine"),
    }


def answer_target_rules() -> dict[str, Column]:
    return {
        "llm_target_id": matches("llm_target_id", IDENTIFIER),
        "model_name": F.col("model_name").isin(*MODEL_NAMES),
        "location_code": matches("location_code", CODE),
        "language_code": matches("language_code", LANGUAGE_TAG),
        "provider_differs": F.lower("provider") != F.lower("platform"),
    }


def comparison_rules() -> dict[str, Column]:
    filled = lambda c: F.length(F.trim(c)) > 0
    return {
        "comparison_id": matches("comparison_id", IDENTIFIER),
        "mapping_version": filled("mapping_version"), "reviewer": filled("reviewer"), "reason": filled("reason"),
        "scope": F.col("scope") == MAPPING_SCOPE,
        "date_range": F.col("effective_end_date").isNull() | (F.col("effective_end_date") >= F.col("effective_start_date")),
    }


def assignment_problems(
    assignments: DataFrame, sources: DataFrame, targets: DataFrame, source: str, target: str
) -> DataFrame:
    """Unknown references, repeated active pairs and active assignments of inactive ends."""
    s = sources.select(source, F.col("active").alias("_source_active"))
    t = targets.select(target, F.col("active").alias("_target_active"))
    rows = assignments.join(s, source, "left").join(t, target, "left")
    active = F.col("active")
    known = F.col("_source_active").isNotNull() & F.col("_target_active").isNotNull()
    first = (
        rows.filter(active).groupBy(source, target)
        .agg(F.min("assignment_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    )
    repeated = rows.filter(active).join(first, [source, target]).filter(F.col("assignment_id") != F.col("_first"))
    return union_all([
        _tagged(rows.filter(F.col("_source_active").isNull()), f"unknown_{source}", "assignment_id"),
        _tagged(rows.filter(F.col("_target_active").isNull()), f"unknown_{target}", "assignment_id"),
        _tagged(repeated, "duplicate_active_pair", "assignment_id"),
        _tagged(rows.filter(active & known & ~F.col("_source_active")), "inactive_source", "assignment_id"),
        _tagged(rows.filter(active & known & ~F.col("_target_active")), "inactive_target", "assignment_id"),
    ])


def comparison_problems(comparisons: DataFrame, queries: DataFrame, prompts: DataFrame) -> DataFrame:
    """Unknown or inactive instruments, repeated active pairs and differing languages."""
    q = queries.select("query_id", F.col("active").alias("_qa"), F.lower("language").alias("_ql"))
    p = prompts.select("prompt_id", F.col("active").alias("_pa"), F.lower("language").alias("_pl"))
    rows = comparisons.join(q, "query_id", "left").join(p, "prompt_id", "left")
    known = F.col("_qa").isNotNull() & F.col("_pa").isNotNull()
    active = F.col("active") & known
    first = (
        rows.filter(active).groupBy("query_id", "prompt_id")
        .agg(F.min("comparison_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    )
    repeated = rows.filter(active).join(first, ["query_id", "prompt_id"]).filter(F.col("comparison_id") != F.col("_first"))
    return union_all([
        _tagged(rows.filter(~known), "unknown_instrument", "comparison_id"),
        _tagged(repeated, "duplicate_active_pair", "comparison_id"),
        _tagged(rows.filter(active & ~(F.col("_qa") & F.col("_pa"))), "inactive_instrument", "comparison_id"),
        _tagged(rows.filter(active & (F.col("_ql") != F.col("_pl"))), "language_differs", "comparison_id"),
    ])


# ---------------------------------------------------------------------------
# Extraction benchmark
# ---------------------------------------------------------------------------


def extraction_benchmark(
    predictions: DataFrame, labels: DataFrame, keys: Sequence[str], strata: Sequence[str]
) -> DataFrame:
    """True and false positives, false negatives, precision and recall per stratum.

    Both inputs list positive items by ``keys`` (which include the strata). A rate without
    support is null, never zero or one.
    """
    p = predictions.select(*keys).distinct().withColumn("_p", F.lit(True))
    l = labels.select(*keys).distinct().withColumn("_l", F.lit(True))
    both = p.join(l, list(keys), "full_outer")
    hit, said, true = F.col("_p") & F.col("_l"), F.col("_p").isNotNull(), F.col("_l").isNotNull()
    counts = both.groupBy(*strata).agg(
        F.count_if(hit).alias("true_positives"),
        F.count_if(said & ~true).alias("false_positives"),
        F.count_if(true & ~said).alias("false_negatives"),
    )
    tp = F.col("true_positives")
    return counts.withColumn("precision", rate(tp, tp + F.col("false_positives"))).withColumn(
        "recall", rate(tp, tp + F.col("false_negatives"))
    )
