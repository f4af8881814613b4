"""Per-observation brand visibility in search pages and generated answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.cols import case, flag, rate
from sightline.functions.ids import joined_hash
from sightline.functions.jsonx import array_length
from sightline.operators.shape import computed, dense_grain, growing, union_all
from sightline.operators.terms import attach_substrings
from sightline.schemas import ANSWER_METRIC, AVAILABLE, SERP_METRIC


def availability(outcome: Column, measured: Column) -> Column:
    """Availability of a measured observation: an available one without rows has no results."""
    return case(
        [
            ((outcome == AVAILABLE) & (measured > 0), AVAILABLE),
            ((outcome == AVAILABLE) & (measured == 0), "no_results"),
            (outcome.isNull(), "not_collected"),
        ],
        outcome,
    )


def brand_organic_hits(organic: DataFrame, items: DataFrame, domains: DataFrame) -> DataFrame:
    """Organic rows on a registered brand domain (equality of normalized domains)."""
    hosts = items.select(
        F.col("serp_item_id").alias("parent_serp_item_id"),
        F.lower("normalized_domain").alias("normalized_domain"),
    )
    registered = domains.filter(F.col("domain").isNotNull()).select(
        F.lower(F.trim("domain")).alias("normalized_domain"), "brand_id"
    )
    rows = organic.join(growing(hosts), "parent_serp_item_id", "left").withColumn(
        "normalized_domain", F.coalesce("normalized_domain", F.lit(""))
    )
    return rows.join(registered, "normalized_domain").select(
        "organic_result_id", "observation_id", "parent_serp_item_id", "search_engine",
        "search_type", "normalized_rank", "canonical_url", "raw_url", "normalized_domain",
        "brand_id",
    )


def count_per(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def hits_per_brand(hits: DataFrame) -> DataFrame:
    return hits.groupBy("observation_id", "brand_id").agg(
        F.count("*").alias("hits"), F.min("normalized_rank").alias("best_rank")
    )


def serp_visibility(
    observations: DataFrame, responses: DataFrame, organic: DataFrame, hits: DataFrame,
    brands: DataFrame,
) -> DataFrame:
    """Organic share of voice per observation and brand.

    Counts are joined while the frame still has one row per observation; the brand grain is
    expanded last, so the dense rows are never shuffled.
    """
    by_brand = hits_per_brand(hits).groupBy("observation_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("brand_id", F.struct("hits", "best_rank")))
        ).alias("_hits")
    )
    received = responses.select("response_id", F.col("received_at_utc").alias("collected_at"))
    base = (
        observations.join(growing(received), "response_id", "left")
        .join(growing(count_per(organic, "observation_id", "_organic")), "observation_id", "left")
        .join(growing(by_brand), "observation_id", "left")
    )
    names = brands.select("brand_id", F.col("canonical_name").alias("brand_canonical_name"))
    dense = dense_grain(base, names, "observation_id")
    own = F.col("_hits")[F.col("brand_id")]
    name, version = SERP_METRIC
    counted = dense.withColumn("numerator", F.coalesce(own["hits"], F.lit(0)).cast("bigint")).withColumn(
        "denominator", F.coalesce("_organic", F.lit(0)).cast("bigint")
    )
    return counted.select(
        joined_hash("observation_id", "brand_id", F.lit(name), F.lit(version)).alias("metric_id"),
        "observation_id", "query_id", "brand_id", "brand_canonical_name", "provider",
        "search_engine", "search_type", "collection_window",
        F.lit("serp").alias("source_category"),
        F.lit(name).alias("metric_name"), F.lit(version).alias("metric_version"),
        "numerator", "denominator",
        F.when(F.col("outcome_status") == AVAILABLE, rate("numerator", "denominator")).alias("metric_value"),
        availability(F.col("outcome_status"), F.col("denominator")).alias("availability_status"),
        F.col("outcome_status").alias("collection_status"),
        "has_results", own["best_rank"].alias("best_normalized_rank"), "response_id",
        "raw_file_hash", "language_code", "location_code", "raw_language_code",
        "raw_location_code", "device", "collected_at",
    )


LEGACY_IGNORED_KEYS = ("raw_item", "result_sources", "json_path")


def strip_item_keys(items_json: Column) -> Column:
    """Item list without later additions, so that those never create first-generation hits."""
    rows = F.try_variant_get(F.try_parse_json(items_json), "$", "array<map<string,variant>>")
    kept = F.transform(
        rows,
        lambda m: F.map_filter(m, lambda k, v: ~k.isin(*LEGACY_IGNORED_KEYS)),
    )
    return F.to_json(kept)


def alias_terms(aliases: DataFrame, brands: DataFrame, text: str = "alias_text") -> DataFrame:
    """identity, needle rows for plain containment; aliases of unknown brands are left out."""
    known = brands.select("brand_id")
    return (
        aliases.filter(F.col(text).isNotNull())
        .join(known, "brand_id")
        .select(F.col("brand_id").alias("identity"), F.lower(F.trim(text)).alias("needle"))
    )


def answer_visibility(
    observations: DataFrame, requests: DataFrame, responses: DataFrame, aliases: DataFrame,
    domains: DataFrame, brands: DataFrame, *, legacy: bool = False,
) -> DataFrame:
    """Brand mention per answer and brand; the numerator counts alias rows found.

    ``legacy=True`` keeps a value for available answers without items; by default such a row has
    no results and no value.
    """
    asked = requests.filter("source_category = 'llm'").select(
        "request_id", F.col("query_id").alias("prompt_id"),
        F.col("collection_window_id").alias("collection_window"),
    )
    received = responses.select("response_id", F.col("received_at_utc").alias("collected_at"))
    # Partitioned by key first: the join with what was found needs that anyway, and texts are cut up by all tasks.
    parts = int(observations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Lambdas do not share work, so the lower-cased texts must exist before terms are tried.
    texts = computed(
        observations.repartition(parts, "observation_id"),
        _answer=F.lower(F.coalesce("response_text", F.lit(""))),
        _items=F.lower(F.coalesce(strip_item_keys(F.col("items_json")), F.lit(""))),
        _citations=F.lower(F.coalesce("citations_json", F.lit(""))),
    )
    cited = attach_substrings(texts, "observation_id", {
        "_mentions": (["_answer", "_items"], alias_terms(aliases, brands)), "_cited": (["_citations"], alias_terms(domains, brands, "domain")),
    }).drop("_answer", "_items", "_citations", "response_text", "items_json", "citations_json")
    base = cited.join(growing(asked), "request_id", "left").join(growing(received), "response_id", "left")
    names = brands.select("brand_id", F.col("canonical_name").alias("brand_canonical_name"))
    dense = dense_grain(base, names, "observation_id")

    def count_of(found: str) -> Column:
        brand = F.col("brand_id")
        return F.coalesce(F.size(F.filter(F.col(found), lambda b: b == brand)), F.lit(0)).cast("bigint")

    name, version = ANSWER_METRIC
    available = F.col("outcome_status") == AVAILABLE
    counted = dense.withColumn("mention_count", count_of("_mentions")).withColumn(
        "citation_count", count_of("_cited")
    )
    valued = available if legacy else available & (F.col("items_count") > 0)
    return counted.select(
        joined_hash("observation_id", "brand_id", F.lit(name), F.lit(version)).alias("metric_id"),
        "observation_id", "prompt_id", "brand_id", "brand_canonical_name", "provider",
        "platform", "model_name", F.lit("llm").alias("source_category"),
        F.lit(name).alias("metric_name"), F.lit(version).alias("metric_version"),
        F.col("mention_count").alias("numerator"),
        F.when(available, F.greatest("items_count", F.lit(1))).otherwise(0).cast("bigint").alias("denominator"),
        F.when(valued, flag(F.col("mention_count") > 0).cast("double")).alias("metric_value"),
        availability(F.col("outcome_status"), F.col("items_count")).alias("availability_status"),
        F.col("outcome_status").alias("collection_status"),
        "mention_count", "citation_count", "request_id", "response_id", "raw_file_hash",
        "language_code", "location_code", "raw_language_code", "raw_location_code",
        "collection_window", "collected_at",
    )


def serp_kpis(
    observations: DataFrame, items: DataFrame, organic: DataFrame, quarantine: DataFrame
) -> DataFrame:
    """Item, organic and quarantine counts of a search observation with its two rates."""
    key = "observation_id"
    # One aggregation over the three tagged inputs instead of three joins.
    tagged = union_all([
        items.select(key, F.lit("items").alias("part")),
        organic.select(key, F.lit("organic").alias("part")),
        quarantine.select(key, F.lit("quarantine").alias("part")),
    ])
    counts = tagged.groupBy(key).agg(
        F.count_if(F.col("part") == "items").alias("serp_item_count"),
        F.count_if(F.col("part") == "organic").alias("organic_result_count"),
        F.count_if(F.col("part") == "quarantine").alias("quarantine_count"),
    )
    filled = observations.join(growing(counts), key, "left").fillna(
        0, ["serp_item_count", "organic_result_count", "quarantine_count"]
    )
    n = F.col("serp_item_count")
    return filled.select(
        joined_hash(key, F.lit("serp_observation_kpi"), F.lit("1.0.0")).alias("measure_id"),
        key, "query_id", "provider", "search_engine", "search_type", "collection_window",
        F.lit("serp_observation_kpi").alias("kpi_name"), F.lit("1.0.0").alias("kpi_version"),
        "serp_item_count", "organic_result_count", "quarantine_count", "has_results",
        rate("serp_item_count", n + F.col("quarantine_count")).alias("parse_success_rate"),
        rate("organic_result_count", "serp_item_count").alias("organic_coverage_rate"),
        availability(F.col("outcome_status"), n).alias("availability_status"),
        F.col("outcome_status").alias("collection_status"),
    )


def answer_kpis(observations: DataFrame) -> DataFrame:
    """Item count, citation count and text length of an answer."""
    items = F.coalesce("items_count", F.lit(0))
    return observations.select(
        joined_hash("observation_id", F.lit("llm_observation_kpi"), F.lit("1.0.0")).alias("measure_id"),
        "observation_id", "request_id", "response_id", "provider", "platform", "model_name",
        "query_text", F.lit("llm_observation_kpi").alias("kpi_name"),
        F.lit("1.0.0").alias("kpi_version"), items.alias("items_count"),
        array_length("citations_json").alias("citation_count"),
        F.length(F.coalesce("response_text", F.lit(""))).alias("response_text_length"),
        availability(F.col("outcome_status"), items).alias("availability_status"),
        F.col("outcome_status").alias("collection_status"), "raw_file_hash",
    )


def locale_coverage(
    search: DataFrame, answers: DataFrame, requests: DataFrame, responses: DataFrame
) -> DataFrame:
    """Distinct observations per source slice, locale, window and status, before any brand grain."""
    received = responses.select("response_id", F.col("received_at_utc").alias("collected_at"))
    asked = requests.filter("source_category = 'llm'").select(
        "request_id", F.col("query_id").alias("instrument_id"),
        F.col("collection_window_id").alias("collection_window"),
    )
    shared = ["provider", "language_code", "location_code", "collection_window", "observation_id",
              "outcome_status", "collected_at", "instrument_id"]
    serp = (
        search.join(growing(received), "response_id", "left")
        .withColumn("instrument_id", F.col("query_id"))
        .select(F.lit("serp").alias("source_category"), *shared,
                F.col("search_engine").alias("platform"), "device")
    )
    answer = (
        answers.join(growing(asked), "request_id", "left").join(growing(received), "response_id", "left")
        .select(F.lit("llm").alias("source_category"), *shared, "platform", "model_name")
    )
    both = union_all([serp, answer], fill=True)
    slice_keys = [
        "source_category", "instrument_id", "provider", "platform", "model_name", "language_code",
        "location_code", "device", "collection_window", "collection_status",
    ]
    return (
        both.withColumn("collection_status", F.coalesce("outcome_status", F.lit("not_collected")))
        .groupBy(*slice_keys)
        .agg(
            F.count_distinct("observation_id").alias("observation_count"),
            F.min("collected_at").alias("first_collected_at"),
            F.max("collected_at").alias("last_collected_at"),
        )
    )
