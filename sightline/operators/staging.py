"""Staging projections: one declarative spec instead of one view per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.cols import ColumnLike, case, col
from sightline.functions.dates import valid_on
from sightline.functions.text import is_placeholder, normalize_language, nullif_trim

Rule = str | Callable[[], Column]


def stage(df: DataFrame, spec: Mapping[str, Rule]) -> DataFrame:
    """Project ``df`` by output name -> rule.

    Rules: ``trim`` (blank to null), ``language`` (normalized code), ``raw:<column>`` (text copy of
    a source column), ``null:<type>``, ``<type>`` or ``<type>:<column>`` (cast), or a function that
    returns a Column.
    """
    return df.select(*[_apply(name, rule).alias(name) for name, rule in spec.items()])


def _apply(name: str, rule: Rule) -> Column:
    if callable(rule):
        return rule()
    kind, _, source = rule.partition(":")
    source = source or name
    if kind == "trim":
        return nullif_trim(source)
    if kind == "language":
        return normalize_language(source)
    if kind == "raw":
        return F.col(source).cast("string")
    if kind == "null":
        return F.lit(None).cast(source)
    return F.col(source).cast(kind)


def success_flag(status: ColumnLike) -> Column:
    """Completed work is true, unknown stays unknown, anything else false."""
    s = col(status)
    return F.when(s.isin("completed", "partial_success"), F.lit(True)).when(
        s.isNotNull(), F.lit(False)
    )


def response_outcome(valid: ColumnLike) -> Column:
    v = col(valid).cast("boolean")
    return case([(v, "valid"), (~v, "invalid")], "unknown")


RUNS = {
    "run_id": "string", "run_status": "string:status", "is_success": lambda: success_flag("status"),
    "started_at_utc": "timestamp:started_at", "completed_at_utc": "timestamp:completed_at",
}
REQUESTS = {
    "request_id": "string", "run_id": "string", "source_category": "trim", "provider": "trim",
    "platform": "trim", "search_engine": "trim", "model_name": "trim",
    "request_status": "trim", "is_success": lambda: success_flag("request_status"),
    "estimated_cost_usd": "double:estimated_cost", "query_id": "string",
    "search_target_id": "string", "collection_window_id": "trim:collection_window",
    "request_hash": "trim", "deduplication_key": "trim",
}
RESPONSES = {
    "response_id": "string", "request_id": "string", "provider_request_id": "trim",
    "response_valid": "boolean", "response_outcome": lambda: response_outcome("response_valid"),
    "actual_cost_usd": "double:actual_cost", "task_id": "trim",
}
ATTEMPTS = {
    "attempt_id": "string", "request_id": "string", "attempt_number": "int",
    "started_at_utc": "timestamp:started_at", "ended_at_utc": "timestamp:ended_at",
    "transport_status": "trim",
}
RAW_FILES = {
    "raw_file_id": "string", "request_id": "string", "artifact_type": "trim",
    "raw_directory": "trim", "relative_path": "trim", "sha256": "trim", "byte_size": "bigint",
    "content_type": "trim", "created_at_utc": "timestamp:created_at",
}
SEARCH_OBSERVATIONS = {
    "observation_id": "string", "query_id": "string", "provider": "trim", "search_engine": "trim",
    "search_type": "trim", "location_code": "trim", "language_code": "language",
    "raw_language_code": "raw:language_code", "raw_location_code": "raw:location_code",
    "device": "trim", "collection_window": "trim", "response_id": "string",
    "source_ingestion_id": "string", "raw_file_hash": "trim", "has_results": "boolean",
    "outcome_status": "trim",
}
ANSWER_OBSERVATIONS = {
    "observation_id": "string", "request_id": "string", "response_id": "string",
    "provider": "trim", "platform": "trim", "model_name": "trim", "query_text": "trim",
    "task_id": "trim", "status_code": "int", "cost": "double", "language_code": "language",
    "location_code": "trim", "raw_language_code": "raw:language_code",
    "raw_location_code": "raw:location_code", "items_count": "int", "response_text": "trim",
    "items_json": "string", "citations_json": "string", "raw_file_hash": "trim",
    "outcome_status": "trim",
}
SERP_ITEMS = {
    "serp_item_id": "string", "observation_id": "string", "engine": "trim", "item_index": "int",
    "raw_item_type": "trim", "normalized_item_type": "trim", "rank_group": "int",
    "rank_absolute": "int", "page": "int", "position": "int", "raw_domain": "trim",
    "normalized_domain": "trim", "raw_url": "trim", "canonical_url": "trim", "title": "trim",
    "description": "trim", "raw_item_json": "string", "normalization_status": "trim",
    "parsing_warning": "trim",
}
ORGANIC_RESULTS = {
    "organic_result_id": "string", "provider": "trim", "search_engine": "trim",
    "search_type": "trim", "observation_id": "string", "parent_serp_item_id": "string",
    "feature_supported": "boolean", "feature_observed": "boolean", "engine_rank": "int",
    "normalized_rank": "int", "raw_url": "trim", "canonical_url": "trim", "title": "trim",
    "description": "trim",
}
QUARANTINE = {
    "quarantine_id": "string", "observation_id": "string", "engine": "trim", "item_index": "int",
    "reason": "trim", "raw_item_json": "string",
}
BRANDS = {
    "brand_id": "string", "canonical_name": "trim", "ownership_type": "trim", "market": "trim",
    "language": "trim", "effective_start_date": "date", "effective_end_date": "date",
    "active": "boolean",
}
ALIASES = {
    "brand_alias_id": "string", "brand_id": "string", "alias_text": "trim", "market": "trim",
    "language": "trim", "effective_start_date": "date", "effective_end_date": "date",
}
DOMAINS = {
    "brand_domain_id": "string", "brand_id": "string", "domain": "trim", "market": "trim",
    "language": "trim", "effective_start_date": "date", "effective_end_date": "date",
}
QUERIES = {"query_id": "string", "keyword": "trim", "active": "boolean"}
PROMPTS = {"prompt_id": "string", "prompt_group": "trim", "active": "boolean"}
SEARCH_TARGETS = {
    "search_target_id": "string", "provider": "trim", "search_engine": "trim",
    "search_type": "trim", "model_name": "trim", "active": "boolean",
}
ANSWER_TARGETS = {
    "llm_target_id": "string", "provider": "trim", "platform": "trim", "model_name": "trim",
    "active": "boolean",
}
COMPARISONS = {
    "comparison_id": "string", "query_id": "string", "prompt_id": "string", "active": "boolean",
}


def effective(df: DataFrame, as_of: ColumnLike) -> DataFrame:
    """Registry rows valid on a date (inclusive bounds, null means open)."""
    return df.filter(valid_on("effective_start_date", "effective_end_date", as_of))


def eligible_brands(brands: DataFrame) -> DataFrame:
    """Active owned or competitor brands with a name that is not a placeholder (the rule of the Gold metrics)."""
    return brands.filter(
        F.col("active")
        & F.lower("ownership_type").isin("owned", "competitor")
        & F.col("canonical_name").isNotNull()
        & ~is_placeholder("canonical_name")
    )


def eligible_brand_rows(brands: DataFrame) -> DataFrame:
    """Active owned or competitor brands without a placeholder in any field (the rule of evidence and research); a name may be missing."""
    return brands.filter(
        F.col("active")
        & F.lower("ownership_type").isin("owned", "competitor")
        & ~is_placeholder(*brands.columns)
    )


def usable_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.filter(F.col("alias_text").isNotNull() & ~is_placeholder("alias_text"))


def usable_domains(domains: DataFrame) -> DataFrame:
    """Registered domains without placeholders and reserved test hosts."""
    return domains.filter(
        F.col("domain").isNotNull() & ~is_placeholder("domain") & ~F.col("domain").endswith(".test")
    )


def select_values(df: DataFrame, selections: Mapping[str, Sequence[str | None] | None]) -> DataFrame:
    """Multi-select filters: ``None`` keeps all, an empty list keeps nothing, a ``None`` member
    keeps rows where the column is unknown."""
    for column, values in selections.items():
        if values is None:
            continue
        known = [v for v in values if v is not None]
        keep = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
        if None in values:
            keep = keep | F.col(column).isNull()
        df = df.filter(keep)
    return df


def filter_channels(
    frames: Mapping[str, DataFrame], *, brands=None, languages=None, locations=None,
    windows=None, engines=None, platforms=None,
) -> dict[str, DataFrame]:
    """The same selection on all channels; engines do not apply to answers, platforms not to
    search pages, and both apply to comparisons."""
    out = {}
    for channel, frame in frames.items():
        selections = {
            "brand_id": brands, "language_code": languages, "location_code": locations,
            "collection_window": windows,
        }
        if channel != "llm":
            selections["search_engine"] = engines
        if channel != "serp":
            selections["platform"] = platforms
        out[channel] = select_values(frame, selections)
    return out


def select_assignments(
    assignments: DataFrame, ids: Sequence[str] = (), engines: Sequence[str] = (),
    platforms: Sequence[str] = (),
) -> DataFrame:
    """Assignments narrowed by id, engine (case-insensitive) and platform; empty means all."""
    if ids:
        assignments = assignments.filter(F.col("assignment_id").isin(list(ids)))
    if engines:
        assignments = assignments.filter(F.lower("search_engine").isin([e.lower() for e in engines]))
    if platforms:
        assignments = assignments.filter(F.col("platform").isin(list(platforms)))
    return assignments


SERP_KIND_FILTERS = {
    "answer_blocks": "item_kind = 'answer_text'",
    "products": "item_kind = 'product'",
    "serp_results": "source_category = 'serp' and is_top_level",
}


def items_of(readable: DataFrame, view: str) -> DataFrame:
    return readable.filter(SERP_KIND_FILTERS[view])
