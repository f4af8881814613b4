"""User-managed registries: strict CSV loading, approval gates, merging, versioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.cols import all_of, case
from sightline.functions.text import is_placeholder
from sightline.operators.shape import union_all

# Registry headers with their column types.
HEADERS: dict[str, dict[str, str]] = {
    "queries": {"query_id": "string", "keyword": "string", "language": "string", "market": "string", "active": "boolean"},
    "search_targets": {
        "search_target_id": "string", "provider": "string", "search_engine": "string",
        "search_type": "string", "retrieval_method": "string", "location_code": "string",
        "language_code": "string", "device": "string", "operating_system": "string",
        "depth": "int", "active": "boolean",
    },
    "llm_prompts": {"prompt_id": "string", "prompt_text": "string", "language": "string", "market": "string", "active": "boolean"},
    "llm_targets": {
        "llm_target_id": "string", "provider": "string", "platform": "string", "model_name": "string",
        "endpoint_name": "string", "location_code": "string", "language_code": "string", "active": "boolean",
    },
    "query_target_assignments": {"assignment_id": "string", "query_id": "string", "search_target_id": "string", "active": "boolean"},
    "prompt_target_assignments": {"assignment_id": "string", "prompt_id": "string", "llm_target_id": "string", "active": "boolean"},
    "brands": {
        "brand_id": "string", "canonical_name": "string", "ownership_type": "string", "market": "string",
        "language": "string", "effective_start_date": "date", "effective_end_date": "date", "active": "boolean",
    },
    "brand_aliases": {
        "brand_alias_id": "string", "brand_id": "string", "alias_text": "string", "market": "string",
        "language": "string", "effective_start_date": "date", "effective_end_date": "date",
    },
    "brand_domains": {
        "brand_domain_id": "string", "brand_id": "string", "domain": "string", "market": "string",
        "language": "string", "effective_start_date": "date", "effective_end_date": "date",
    },
    "comparisons": {
        "comparison_id": "string", "query_id": "string", "prompt_id": "string", "active": "boolean",
        "mapping_version": "string", "reviewer": "string", "approval_date": "date", "reason": "string",
        "effective_start_date": "date", "effective_end_date": "date", "scope": "string",
    },
}
RULE_COLUMNS = (
    "rule_id", "category_id", "category_name", "term", "matched_field", "item_kind",
    "taxonomy_version", "rule_version",
)
RULE_FIELDS = (
    "title", "description", "text", "original_text", "markdown", "brand", "category",
    "product_category",
)
BOM = "﻿"


class RegistryError(ValueError):
    """A registry file or row breaks its contract."""


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a byte-order mark on the first header is dropped."""
    df = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    return df.toDF(*[c.removeprefix(BOM) for c in df.columns])


def check_header(df: DataFrame, registry: str) -> DataFrame:
    expected, found = set(HEADERS[registry]), set(df.columns)
    if expected != found:
        raise RegistryError(
            f"{registry}: missing {sorted(expected - found)}, unexpected {sorted(found - expected)}"
        )
    return df


def coerce(df: DataFrame, registry: str) -> DataFrame:
    """Typed registry plus ``problems``: names of the columns whose text has no valid value.

    Booleans are true or false in any case, depths whole numbers, dates ISO days; an empty end
    date is open.
    """
    typed: list[Column] = []
    problems: list[Column] = []
    for name, kind in HEADERS[registry].items():
        raw = F.coalesce(F.col(name), F.lit(""))
        if kind == "boolean":
            low = F.lower(raw)
            value = case([(low == "true", F.lit(True)), (low == "false", F.lit(False))], F.lit(None).cast("boolean"))
        elif kind == "date":
            iso = raw.rlike(r"^\d{4}-\d{2}-\d{2}$")
            value = F.when(iso, raw.try_cast("date"))
        elif kind == "int":
            value = F.when(raw.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(raw).try_cast("int"))
        else:
            value = raw
        typed.append(value.alias(name))
        if kind != "string":
            optional = (raw == "") if name.endswith("end_date") else F.lit(False)
            problems.append(F.when(value.isNull() & ~optional, F.lit(name)))
    found = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    return df.select(*typed, found.alias("problems"))


def load_registry(spark: SparkSession, path: str, registry: str) -> DataFrame:
    """Typed rows of a registry file; ``problems`` lists what failed per row."""
    return coerce(check_header(read_csv(spark, path), registry), registry)


def approved_rules(rules: DataFrame) -> DataFrame:
    """Approved, active category rules; there are no default classifications."""
    return rules.filter((F.col("review_status") == "approved") & (F.lower("active") == "true"))


def rule_problems(rules: DataFrame) -> DataFrame:
    """Approved rules with missing or placeholder fields, a forbidden field, or a repeated id."""
    approved = approved_rules(rules)
    filled = all_of(*[F.length(F.coalesce(c, F.lit(""))) > 0 for c in RULE_COLUMNS])
    text_columns = [c for c in rules.columns]
    repeated = approved.groupBy("rule_id").agg(F.count("*").alias("_n")).filter("_n > 1")
    return union_all([
        approved.filter(~filled | is_placeholder(*text_columns)).select("rule_id", F.lit("missing_or_placeholder_field").alias("problem")),
        approved.filter(~F.col("matched_field").isin(*RULE_FIELDS)).select("rule_id", F.lit("field_not_classifiable").alias("problem")),
        repeated.select("rule_id", F.lit("duplicate_rule_id").alias("problem")),
    ])


def open_candidates(candidates: DataFrame) -> DataFrame:
    """Candidate names still under review with all identifying fields filled."""
    filled = all_of(*[F.length(F.coalesce(c, F.lit(""))) > 0 for c in ("candidate_id", "candidate_name", "alias_text")])
    return candidates.filter((F.col("review_status") == "candidate") & filled)


def merge_authoritative(
    csv_rows: DataFrame, stored_rows: DataFrame, key: str, ignore: Sequence[str] = ("recorded_at", "source")
) -> DataFrame:
    """CSV rows win; a stored row is used only when all its sources agree on it.

    Adds ``origin``: ``csv``, ``stored`` or ``conflict`` (disagreeing stored rows, values null).
    Rows carrying the sanitizing marker are never used.
    """
    columns = [c for c in csv_rows.columns if c != key]
    compared = [c for c in columns if c not in ignore]
    whole = F.to_json(F.struct(*compared), {"ignoreNullFields": "false"})
    usable = stored_rows.withColumn("_json", whole).filter(~F.lower("_json").contains("sanitized"))
    grouped = usable.join(csv_rows.select(key), key, "left_anti").groupBy(key).agg(
        (F.min("_json") == F.max("_json")).alias("_agree"),
        F.min(F.struct("_json", *columns)).alias("_row"),
    )
    stored = grouped.select(
        key, *[F.when(F.col("_agree"), F.col("_row")[c]).alias(c) for c in columns],
        F.when(F.col("_agree"), "stored").otherwise("conflict").alias("origin"),
    )
    return csv_rows.withColumn("origin", F.lit("csv")).unionByName(stored)


def exclusion_reason(registry: str) -> Column:
    """Why a merged row is left out; null when it is used. Parent flags are joined in before."""
    if registry == "brands":
        bad = (F.col("ownership_type") == "TO_BE_VERIFIED") | F.lower("canonical_name").contains("example")
        return F.when(bad, "unapproved placeholder brand")
    branches = [(~F.col("parent_known"), "brand not approved")]
    if registry == "brand_domains":
        branches = [(F.col("domain").endswith(".test"), "placeholder domain"), *branches]
    if registry == "comparisons":
        branches = [(~F.col("parent_known"), "missing authoritative query/prompt registry")]
    return case(branches)


def with_parent(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    known = parent.select(key).distinct().withColumn("_known", F.lit(True))
    return rows.join(known, key, "left").withColumn("parent_known", F.coalesce("_known", F.lit(False))).drop("_known")


def active_on(comparisons: DataFrame, day: Column) -> DataFrame:
    """Comparisons with ``active`` switched off outside their effective window."""
    inside = (F.col("effective_start_date") <= day) & (
        F.col("effective_end_date").isNull() | (day <= F.col("effective_end_date"))
    )
    return comparisons.withColumn("active", F.col("active") & F.coalesce(inside, F.lit(False)))


def registry_version(registries: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a content hash of the registries, independent of row order.

    Row hashes are added up (a commutative sum over 60-bit pieces), so no row list is gathered.
    """
    parts = []
    for name in sorted(registries):
        df = registries[name]
        row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
        piece = lambda i, r=row: F.conv(F.substring(r, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")
        parts.append(df.agg(
            F.lit(name).alias("name"), F.count("*").alias("n"),
            *[F.sum(piece(i)).alias(f"s{i}") for i in range(4)],
        ))
    rows = union_all(parts)
    line = F.concat_ws("|", "name", "n", "s0", "s1", "s2", "s3")
    return rows.agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(line))), 256).alias("registry_version"))


def dimension_counts(query_assignments: DataFrame, prompt_assignments: DataFrame) -> DataFrame:
    """Assignment counts per provider, engine, platform, market and activity.

    Inputs already carry their target's and source's columns; each row is counted once per
    dimension through one unpivot.
    """
    dims = ("provider", "search_engine", "platform", "market", "active")
    both = query_assignments.unionByName(prompt_assignments, allowMissingColumns=True)
    text = both.select("assignment_id", *[F.col(d).cast("string").alias(d) for d in dims])
    long = text.unpivot(["assignment_id"], list(dims), "dimension", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("dimension", "value").agg(F.count("*").alias("assignments"))
