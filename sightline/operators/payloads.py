"""Provider payloads to rows: envelopes, statuses, search items, answers, quarantine."""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions import jsonx
from sightline.functions.cols import any_of, case
from sightline.functions.ids import candidate_id, uuid5
from sightline.functions.text import redact_json_parameters, redact_parameters
from sightline.functions.url import legacy_canonical_url, normalized_domain
from sightline.operators.shape import computed, growing, union_all
from sightline.schemas import ERROR_CODE_FLOOR, KNOWN_SERP_ITEM_TYPES, PARSED_ENGINES, PENDING_CODES

# The two envelope orders and the request defaults.
EVIDENCE_ENVELOPES = ("retrieval", "live_advanced", "get", "post")
INCREMENTAL_ENVELOPES = ("retrieval", "post", "get")
CONTEXT_DEFAULTS = {
    "search_type": ("se_type", "organic"),
    "location_code": ("location_code", "2840"),
    "language_code": ("language_code", "en"),
    "device": ("device", "desktop"),
}


def unwrap(df: DataFrame, payload: str, families: Sequence[str] = EVIDENCE_ENVELOPES) -> DataFrame:
    """Adds ``family`` and ``block``: the first envelope holding tasks, else the payload itself."""
    body = F.col(payload)
    branches = [
        (jsonx.is_object(body, f"$.{name}") & jsonx.present(body, f"$.{name}.tasks"), name)
        for name in families
    ]
    direct = (jsonx.present(body, "$.tasks"), "direct")
    family = case([*branches, direct])
    named = computed(df, family=family)
    blocks = case([(F.col("family") == n, jsonx.get(body, f"$.{n}")) for n in families], body)
    return computed(named, block=blocks)


def single_task(block: str) -> Column:
    """The only task of a block when there is exactly one and it is an object."""
    tasks = jsonx.elements(block, "$.tasks")
    return F.when(
        (F.size(tasks) == 1) & jsonx.is_object(block, "$.tasks[0]"), jsonx.get(block, "$.tasks[0]")
    )


def with_task(df: DataFrame) -> DataFrame:
    """Adds ``task`` and its request ``data`` to unwrapped payloads."""
    df = computed(df, task=single_task("block"))
    return computed(df, data=F.when(jsonx.is_object("task", "$.data"), jsonx.get("task", "$.data")))


def _failed(block: str, task: str) -> Column:
    codes = [jsonx.integer(block, "$.status_code"), jsonx.integer(task, "$.status_code")]
    return any_of(*[F.coalesce(c >= ERROR_CODE_FLOOR, F.lit(False)) for c in codes])


def _waiting(task: str) -> Column:
    return F.coalesce(jsonx.integer(task, "$.status_code").isin(*PENDING_CODES), F.lit(False))


def with_status(df: DataFrame) -> DataFrame:
    """Adds ``task``, ``data``, ``provider_status`` and ``status_problem`` to unwrapped payloads."""
    df = with_task(df)
    results = jsonx.as_list("task", "$.result")
    bad_rows = F.exists(results, lambda r: ~jsonx.is_object(r))
    absent = ~jsonx.present("task", "$.result") | F.is_variant_null(jsonx.get("task", "$.result"))
    problem = case([
        (F.col("family").isNull(), "unsupported_envelope"),
        (F.col("task").isNull(), "malformed_task_count"),
        (_failed("block", "task") | _waiting("task"), None),
        (absent, "missing_result"),
        (results.isNull() | bad_rows, "malformed_result"),
    ])
    status = case([
        (F.col("status_problem").isNotNull(), "quarantined"),
        (_failed("block", "task"), "provider_error"),
        (_waiting("task"), "pending"),
        (F.size(results) > 0, "available"),
    ], "no_results")
    return computed(computed(df, status_problem=problem), provider_status=status)


def request_context(df: DataFrame, data: str = "data") -> DataFrame:
    """Adds the request dimensions of a payload with their defaults."""
    return computed(df, **{
        name: F.coalesce(jsonx.scalar_text(data, f"$.{key}"), F.lit(default))
        for name, (key, default) in CONTEXT_DEFAULTS.items()
    })


def payload_problem(block: str) -> Column:
    """Why a search payload has no usable item list; null when it has one or is simply empty."""
    results = jsonx.as_list(block, "$.tasks[0].result")
    result = jsonx.get(block, "$.tasks[0].result")
    bad = F.exists(
        results,
        lambda r: ~jsonx.is_object(r)
        | (
            jsonx.present(r, "$.items")
            & ~F.is_variant_null(jsonx.get(r, "$.items"))
            & ~jsonx.is_list(r, "$.items")
        ),
    )
    return case([
        (~F.coalesce(jsonx.is_object(block, "$.tasks[0]") & jsonx.is_list(block, "$.tasks"), F.lit(False)), "malformed_payload"),
        (result.isNull() | F.is_variant_null(result), None),
        (results.isNull(), "malformed_result"),
        (bad, "malformed_result"),
    ])


PAYLOAD_COLUMNS = ("payload", "block", "task", "data")


def raw_items(df: DataFrame) -> DataFrame:
    """One row per raw item of all results, in payload order (``item_index`` from 0)."""
    lists = F.transform(
        jsonx.as_list("block", "$.tasks[0].result"),
        lambda r: F.coalesce(jsonx.as_list(r, "$.items"), F.array().cast("array<variant>")),
    )
    rows = df.filter(F.col("payload_problem").isNull()).select(
        *[c for c in df.columns if c not in PAYLOAD_COLUMNS],
        F.posexplode(F.flatten(lists)).alias("item_index", "item"),
    )
    return computed(
        rows, raw_item_json=F.coalesce(jsonx.canonical("item"), F.lit("null")),
        item_type=F.when(jsonx.is_object("item"), jsonx.text("item", "$.type")),
    )


def observation_id(*, rekeyed: bool = True) -> Column:
    """Search observation id; by default on the finer response-and-hash grain, so that a second
    response in the same window stays apart from the first."""
    base = uuid5(F.concat_ws(
        "|", "query_id", "provider", F.lower("search_engine"), "search_type", "location_code",
        "language_code", "device", "collection_window",
    ))
    if not rekeyed:
        return base
    return uuid5(F.concat_ws("|", F.lit("raw-full"), base, "response_id", "raw_file_hash"))


def search_observations(payloads: DataFrame, *, rekeyed: bool = True) -> DataFrame:
    """Observation rows from unwrapped payloads with request dimensions.

    Input: block plus query_id, provider, search_engine, search_type, location_code,
    language_code, device, collection_window, response_id, raw_file_hash (and provider_status).
    """
    df = computed(
        payloads, payload_problem=payload_problem("block"), observation_id=observation_id(rekeyed=rekeyed)
    )
    has_items = F.exists(
        jsonx.as_list("block", "$.tasks[0].result"),
        lambda r: F.size(F.coalesce(jsonx.as_list(r, "$.items"), F.array().cast("array<variant>"))) > 0,
    )
    df = computed(df, has_results=F.col("payload_problem").isNull() & F.coalesce(has_items, F.lit(False)))
    parsed = F.when(F.col("has_results"), "available").otherwise("no_results")
    if rekeyed:
        parsed = case([
            (F.col("provider_status").isin("pending", "provider_error"), F.col("provider_status")),
            (F.col("payload_problem").isNotNull(), "quarantined"),
        ], parsed)
    return df.withColumn("outcome_status", parsed)


def _bad_rank(path: str) -> Column:
    """A rank is given but is not a positive integer."""
    given = jsonx.present("item", path) & ~F.is_variant_null(jsonx.get("item", path))
    return given & jsonx.positive("item", path).isNull()


def item_reasons(*, single: bool = False) -> Column:
    """Quarantine reasons of one raw item; ``single`` keeps only the last check that fired."""
    malformed = F.col("item_type").isNull()
    unknown = ~F.col("item_type").isin(*KNOWN_SERP_ITEM_TYPES)
    ranks = F.coalesce(_bad_rank("$.rank_group") | _bad_rank("$.rank_absolute"), F.lit(False))
    if single:
        reason = case([(malformed, "malformed_item"), (ranks, "invalid_rank"), (unknown, "unknown_item_type")])
        return F.array_compact(F.array(reason))
    return F.when(malformed, F.array(F.lit("malformed_item"))).otherwise(
        F.array_compact(F.array(
            F.when(unknown, F.lit("unknown_item_type")), F.when(ranks, F.lit("invalid_rank")),
        ))
    )


def serp_items(items: DataFrame, *, keep_page: bool = False) -> DataFrame:
    """Normalized items; malformed ones are left to the quarantine."""
    kept = computed(
        items.filter(F.col("item_type").isNotNull()), _reasons=item_reasons(single=keep_page),
        _url=jsonx.nonempty("item", "$.url"), _domain=jsonx.nonempty("item", "$.domain"),
    )
    kind, url, domain = F.col("item_type"), F.col("_url"), F.col("_domain")
    rank = jsonx.positive("item", "$.rank_group").cast("int")
    page = jsonx.integer("item", "$.page").cast("int") if keep_page else F.lit(None).cast("int")
    return kept.select(
        uuid5(F.concat_ws("|", "observation_id", F.col("item_index").cast("string"), "raw_item_json")).alias("serp_item_id"),
        "observation_id", F.lower("search_engine").alias("engine"), "response_id",
        "raw_file_hash", "item_index", kind.alias("raw_item_type"),
        F.when(kind.isin(*KNOWN_SERP_ITEM_TYPES), kind).otherwise("unknown").alias("normalized_item_type"),
        rank.alias("rank_group"),
        jsonx.positive("item", "$.rank_absolute").cast("int").alias("rank_absolute"),
        page.alias("page"), rank.alias("position"),
        domain.alias("raw_domain"), normalized_domain(domain, url).alias("normalized_domain"),
        url.alias("raw_url"), legacy_canonical_url(url).alias("canonical_url"),
        jsonx.nonempty("item", "$.title").alias("title"),
        jsonx.nonempty("item", "$.description").alias("description"),
        "raw_item_json",
        F.when(F.size("_reasons") == 0, "normalized").otherwise("warning").alias("normalization_status"),
        F.nullif(F.array_join("_reasons", ";"), F.lit("")).alias("parsing_warning"),
    )


def serp_quarantine(observations: DataFrame, items: DataFrame, *, single: bool = False) -> DataFrame:
    """Every unsafe element: payload problems (no item index) and item reasons."""
    keep = ["observation_id", "search_engine", "response_id", "raw_file_hash"]
    whole = observations.filter(F.col("payload_problem").isNotNull()).select(
        *keep, F.lit(None).cast("int").alias("item_index"),
        F.col("payload_problem").alias("reason"), F.lit(None).cast("string").alias("raw_item_json"),
    )
    parts = items.select(
        *keep, "item_index", F.explode(item_reasons(single=single)).alias("reason"), "raw_item_json"
    )
    return union_all([whole, parts]).select(
        uuid5(F.concat(
            F.col("observation_id"), F.lit("|"), F.coalesce(F.col("item_index").cast("string"), F.lit("None")),
            F.lit("|"), F.col("reason"), F.lit("|"), F.coalesce("raw_item_json", F.lit("None")),
        )).alias("quarantine_id"),
        "observation_id", F.lower("search_engine").alias("engine"), "item_index", "reason", "raw_item_json",
    )


def organic_results(items: DataFrame, observations: DataFrame, engines: Sequence[str] = PARSED_ENGINES) -> DataFrame:
    """Organic feature rows: known organic items with an absolute rank on a supported engine."""
    context = observations.select("observation_id", "provider", "search_type", F.lower("search_engine").alias("search_engine"))
    rows = items.filter(
        (F.col("normalized_item_type") == "organic") & F.col("rank_absolute").isNotNull()
        & F.col("engine").isin(list(engines))
    )
    return rows.join(growing(context), "observation_id").select(
        uuid5(F.concat_ws("|", "serp_item_id", F.lit("organic"), F.col("item_index").cast("string"))).alias("organic_result_id"),
        "provider", "search_engine", "search_type", "observation_id",
        F.col("serp_item_id").alias("parent_serp_item_id"),
        F.col("raw_item_type").alias("source_item_type"),
        F.lit(True).alias("feature_supported"), F.lit(True).alias("feature_observed"),
        "normalization_status", F.col("raw_item_json").alias("raw_evidence"),
        F.col("rank_absolute").alias("engine_rank"), F.col("rank_absolute").alias("normalized_rank"),
        "raw_url", "canonical_url", "title", "description",
    )


def feature_capability(observations: DataFrame, organic: DataFrame, engines: Sequence[str] = PARSED_ENGINES) -> DataFrame:
    """Whether organic rows are supported by the engine and whether the response showed any."""
    seen = organic.select("observation_id").distinct().withColumn("_seen", F.lit(True))
    return observations.join(growing(seen), "observation_id", "left").select(
        "observation_id", F.lower("search_engine").alias("search_engine"),
        F.lit("organic").alias("feature_name"),
        F.lower("search_engine").isin(list(engines)).alias("feature_supported"),
        F.coalesce("_seen", F.lit(False)).alias("feature_observed"),
    )


# ---------------------------------------------------------------------------
# Generated answers
# ---------------------------------------------------------------------------

CITATION_FIELDS = ("domain", "source_name", "title", "url", "snippet", "markdown", "type")


def answer_problem(payload: str) -> Column:
    """Why an answer payload cannot be flattened; null when it can."""
    tasks = jsonx.as_list(payload, "$.retrieval.tasks")
    results = jsonx.as_list(payload, "$.retrieval.tasks[0].result")
    return case([
        (F.col(payload).isNull() | ~jsonx.is_object(payload), "malformed_payload"),
        (~jsonx.is_object(payload, "$.retrieval"), "missing_retrieval"),
        (F.coalesce(F.size(tasks), F.lit(0)) < 1, "missing_tasks"),
        (F.size(tasks) > 1, "multiple_tasks"),
        (~jsonx.is_object(payload, "$.retrieval.tasks[0]"), "malformed_task"),
        (F.coalesce(F.size(results), F.lit(0)) < 1, "missing_results"),
        (F.size(results) > 1, "multiple_results"),
        (~jsonx.is_object(payload, "$.retrieval.tasks[0].result[0]"), "malformed_result"),
    ])


def _first_text(value: Column, *keys: str) -> Column:
    return F.coalesce(*[jsonx.nonempty(value, f"$.{k}") for k in keys])


def _citation(source: Column) -> Column:
    return F.struct(*[F.try_variant_get(source, f"$.{f}", "string").alias(f) for f in CITATION_FIELDS])


def _sources(item: Column) -> Column:
    listed = F.coalesce(jsonx.as_list(item, "$.sources"), F.array().cast("array<variant>"))
    return F.transform(F.filter(listed, lambda s: jsonx.is_object(s)), _citation)


def flatten_answers(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per answer payload with its items, citations and context.

    A payload with any structural problem keeps its row with ``answer_problem`` set.
    """
    df = computed(
        payloads, answer_problem=answer_problem(payload), _task=jsonx.get(payload, "$.retrieval.tasks[0]")
    )
    df = computed(df, _result=F.when(F.col("answer_problem").isNull(), jsonx.get("_task", "$.result[0]")))
    listed = F.coalesce(jsonx.as_list("_result", "$.items"), F.array().cast("array<variant>"))
    numbered = F.transform(listed, lambda x, i: F.struct(i.alias("index"), x.alias("raw")))
    items = F.transform(
        F.filter(numbered, lambda n: jsonx.is_object(n["raw"])),
        lambda n: F.struct(
            n["index"].alias("index"),
            F.coalesce(F.try_variant_get(n["raw"], "$.type", "string"), F.lit("unknown")).alias("item_type"),
            jsonx.integer(n["raw"], "$.rank_group").alias("rank_group"),
            jsonx.integer(n["raw"], "$.rank_absolute").alias("rank_absolute"),
            F.trim(F.coalesce(_first_text(n["raw"], "original_text", "markdown"), F.lit(""))).alias("text"),
            jsonx.text(n["raw"], "$.markdown").alias("markdown"),
            F.concat(
                F.lit("$.retrieval.tasks[0].result[0].items["), n["index"].cast("string"), F.lit("]")
            ).alias("json_path"),
            _sources(n["raw"]).alias("sources"),
            n["raw"].alias("raw_item"),
        ),
    )
    df = computed(df, items=items)
    joined = F.nullif(
        F.array_join(
            F.filter(F.transform("items", lambda i: i["text"]), lambda t: t != ""), "\n\n"
        ),
        F.lit(""),
    )
    r, t = F.col("_result"), F.col("_task")
    data = lambda key: jsonx.scalar_text(t, f"$.data.{key}")
    result = lambda key: jsonx.scalar_text(r, f"$.{key}")
    ok = F.col("answer_problem").isNull()
    return (
        df.withColumn("platform", F.when(ok, F.lower(F.coalesce(data("se"), F.lit("unknown")))).otherwise("unknown"))
        .withColumn("model_name", F.when(ok, F.coalesce(result("model"), data("model"))))
        .withColumn("model_name", F.coalesce("model_name", F.lit("unknown")))
        .withColumn("query_text", F.when(ok, F.coalesce(data("keyword"), result("keyword"))))
        .withColumn("task_id", F.when(ok, jsonx.scalar_text(t, "$.id")))
        .withColumn("status_code", F.when(ok, F.coalesce(jsonx.integer(payload, "$.retrieval.status_code"), jsonx.integer(t, "$.status_code"))))
        .withColumn("cost", F.when(ok, F.coalesce(jsonx.number(payload, "$.retrieval.cost"), jsonx.number(t, "$.cost"))))
        .withColumn("language_code", F.when(ok, F.coalesce(data("language_code"), result("language_code"))))
        .withColumn("location_code", F.when(ok, F.coalesce(data("location_code"), result("location_code"))))
        .withColumn("items_count", F.size("items"))
        .withColumn("citations", F.flatten(F.transform("items", lambda i: i["sources"])))
        .withColumn("response_text", F.when(ok, F.nullif(F.trim(F.coalesce(jsonx.nonempty(r, "$.markdown"), joined)), F.lit(""))))
        .drop("_task", "_result")
    )


def answer_observations(flattened: DataFrame) -> DataFrame:
    """Observation rows with outcome: quarantined, available with items, otherwise no results."""
    outcome = case(
        [(F.col("answer_problem").isNotNull(), "quarantined"), (F.col("items_count") > 0, "available")],
        "no_results",
    )
    slim = F.transform(
        "items",
        lambda i: F.struct(*[i[c].alias(c) for c in (
            "index", "item_type", "rank_group", "rank_absolute", "text", "markdown", "json_path", "sources",
        )]),
    )
    return flattened.select(
        uuid5(F.concat_ws("|", "request_id", "response_id", "raw_file_hash", F.lit("llm"))).alias("observation_id"),
        "request_id", "response_id", "platform", "model_name", "query_text", "task_id",
        F.col("status_code").cast("int").alias("status_code"), "cost", "language_code",
        "location_code", "items_count", "response_text",
        F.to_json(slim, {"ignoreNullFields": "false"}).alias("items_json"),
        F.to_json("citations", {"ignoreNullFields": "false"}).alias("citations_json"),
        "raw_file_hash", outcome.alias("outcome_status"), "answer_problem",
    )


def answer_items(flattened: DataFrame) -> DataFrame:
    """One row per answer item."""
    return flattened.select("request_id", F.explode("items").alias("i")).select(
        "request_id", "i.index", "i.item_type", "i.rank_group", "i.rank_absolute", "i.text",
        "i.json_path", F.size("i.sources").alias("source_count"),
    )


def explicit_brands(items: DataFrame) -> DataFrame:
    """Name proposals from the explicit brand field of product items, with their lineage.

    Input: item_id, observation_id, result_id, json_path, item_kind and ``value`` (VARIANT).
    """
    name = F.trim(jsonx.text("value", "$.brand"))
    rows = items.filter(F.col("item_kind") == "product").withColumn("candidate_name", F.nullif(name, F.lit("")))
    return rows.filter(F.col("candidate_name").isNotNull()).select(
        candidate_id("candidate_name").alias("candidate_id"), "candidate_name",
        F.lit("candidate").alias("review_status"),
        F.lit("explicit_product_brand_field_v1").alias("method"),
        "observation_id", "result_id", "item_id", "json_path",
        F.lit("brand").alias("matched_field"), jsonx.text("value", "$.brand").alias("matched_text"),
    )


# Keys that carry credentials.
SENSITIVE_KEYS = (
    "authorization", "password", "login", "api_key", "apikey", "token", "secret",
)


JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},:]|[^\s"\[\]{},:]+')


def without_members(text: str, names: Collection[str] = SENSITIVE_KEYS) -> str:
    """Compact JSON text without the members of the named keys at any depth.

    One pass over the tokens, so the nesting is not limited; numbers and strings keep their spelling.
    """
    out: list[str] = []
    skip, level = None, 0  # level: depth of brackets; skip: the level at which a dropped member ends
    tokens = JSON_TOKEN.findall(text)
    for i, token in enumerate(tokens):
        closing = token in ("}", "]")
        if skip is not None and ((closing or token == ",") and level == skip):
            skip = None
            if token == "," and out[-1] not in ("{", "["):
                out.append(token)
                continue
            if token == ",":
                continue
        if skip is None and token[0] == '"' and tokens[i + 1 : i + 2] == [":"]:
            if json.loads(token).casefold() in names:
                skip = level
                if out[-1] == ",":
                    out.pop()
        if token in ("{", "["):
            level += 1
        elif closing:
            level -= 1
        if skip is None:
            out.append(token)
    return "".join(out)


@F.pandas_udf(T.StringType())
def _without_credentials(text: pd.Series) -> pd.Series:
    return text.map(without_members, na_action="ignore")


def sanitized(df: DataFrame, column: str) -> DataFrame:
    """JSON text without credential keys, at any depth, and with credential URL parameters redacted in its strings.

    Only payloads that name a credential leave the JVM. Text that is not JSON only gets the parameter redaction.
    """
    clean = jsonx.canonical(jsonx.parse(column))
    named = F.when(clean.rlike('(?iu)"(?:' + "|".join(SENSITIVE_KEYS) + ')":'), clean)
    rows = df.withColumn("_clean", clean).withColumn("_cut", _without_credentials(named))
    text = redact_json_parameters(F.coalesce("_cut", "_clean"))
    return rows.withColumn(column, F.coalesce(text, redact_parameters(column))).drop("_clean", "_cut")
