"""Text, URL, payload, evidence-tree and feature-measure queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import ids, jsonx
from sightline.functions import text as tx
from sightline.functions import url as ur
from sightline.operators import evidence, features, payloads, presence, quality, release, research_snapshot, tree
from sightline.operators import response_evidence as first
from sightline.operators import staging as st
from sightline.operators.shape import growing
from sightline.operators.terms import match_spans, term_table
from sightline.plans.bindings import Inputs
from sightline.plans.catalog import query, step
from sightline.plans.visibility_queries import aliases, brands, domains

UUID_NS = "6ba7b8119dad11d180b400c04fd430c8"


def duck_uuid5(name: str) -> str:
    h = f"sha1(unhex('{UUID_NS}') || encode({name}))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def duck_evidence_id(*parts: str) -> str:
    """uuid5 over a JSON list of SQL string expressions without characters that need escaping."""
    inner = " || ', ' || ".join(f"'\"' || {p} || '\"'" for p in parts)
    return duck_uuid5(f"'[' || {inner} || ']'")


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------


@query("deterministic_ids", f"""
    select c_custkey, {duck_uuid5("c_name || '|' || c_mktsegment")} as name_uuid, {duck_evidence_id('c_name', 'c_mktsegment')} as evidence_id,
      md5(concat_ws('|', c_name, nullif(c_mktsegment, 'BUILDING'), '1.0.0')) as joined, md5(to_json(list_value(c_name, nullif(c_mktsegment, 'BUILDING'), '2.0.0'))) as positional,
      'candidate-' || substr(sha256(lower(c_name)), 1, 24) as candidate, sha256(c_name || chr(31) || c_mktsegment) as dedup,
      sha256('{{"name":"' || c_name || '","nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}}') as request from customer""")
def _(i):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return i.table("customer").select(
        "c_custkey", ids.uuid5(F.concat_ws("|", "c_name", "c_mktsegment")).alias("name_uuid"),
        ids.evidence_id(ids.text_part("c_name"), ids.text_part("c_mktsegment")).alias("evidence_id"),
        ids.joined_hash("c_name", segment, F.lit("1.0.0")).alias("joined"),
        ids.positional_hash("c_name", segment, F.lit("2.0.0")).alias("positional"),
        ids.candidate_id(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("candidate"),
        ids.deduplication_key("c_name", "c_mktsegment").alias("dedup"),
        ids.request_hash({"segment": F.col("c_mktsegment"), "name": F.col("c_name"), "nation": F.col("c_nationkey")}).alias("request"),
    )


PAGE_VARIANT = "case page_id % 5 when 0 then 'HTTPS://' || upper(substr(url, instr(url, '://') + 3, 3)) || substr(url, instr(url, '://') + 6) when 1 then replace(url, '.example.', '.example.:8443x') when 2 then replace(url, '/en/', ':443/en/') when 3 then replace(url, '://', '://user:pw@') else url end"
HOST_SQL = "nullif(rtrim(lower(regexp_extract({0}, '^(?i:https?)://([^/?#:@\\s]+)(:[0-9]*)?([/?#]|$)', 1)), '.'), '')"


@query("url_normalization", f"""
    with v as (select page_id, {PAGE_VARIANT} as u from pages), h as (select *, {HOST_SQL.format('u')} as host,
      regexp_extract(u, '^[a-zA-Z]+://[^/?#]*?:([0-9]+)[/?#]', 1) as port, regexp_replace(regexp_replace(u, '^[a-zA-Z]+://[^/?#]*', ''), '#.*$', '') as rest from v)
    select page_id, host, case when (starts_with(u, 'http://') or starts_with(u, 'https://')) and host is not null then split_part(u, ':', 1) || '://' || host ||
        case when port = '' or (port = '443' and starts_with(u, 'https:')) or (port = '80' and starts_with(u, 'http:')) then '' else ':' || port end || case when starts_with(rest, '/') then rest else '/' || rest end end as canonical,
      lower(regexp_extract(u, '^[a-zA-Z]+://[^/?#]+')) || rest as legacy,
      lower(regexp_replace(regexp_replace(regexp_extract(u, '^[a-zA-Z]+://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')) as domain from h""")
def _(i):
    rows = i.table("pages").select("page_id", F.expr(PAGE_VARIANT).alias("u"))
    return rows.select(
        "page_id", ur.hostname("u").alias("host"), ur.canonical_url("u").alias("canonical"),
        ur.legacy_canonical_url("u").alias("legacy"),
        ur.normalized_domain(F.lit(None).cast("string"), "u").alias("domain"),
    )


@query("domain_ownership", f"""
    with h as (select page_id, {HOST_SQL.format('url')} as host from pages),
    reg as (select distinct regexp_extract(host, '[^.]+\\.[^.]+\\.[^.]+$') as registered from h where page_id % 3 = 0 union select 'example.net')
    select page_id, host, registered from h join reg on host = registered or ends_with(host, '.' || registered) where registered <> ''""")
def _(i):
    pages = i.table("pages").select("page_id", ur.hostname("url").alias("host"))
    three = F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0)
    registry = pages.filter("page_id % 3 = 0").select(three.alias("registered")).union(
        pages.select(F.lit("example.net"))
    ).filter("registered <> ''").distinct()
    hosts = registry.select("registered", F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"))
    return evidence.owned_hosts(pages, "host", hosts).select("page_id", "host", "registered")


LINKED = "'see [page ' || cast(page_id as string) || '](' || url || ') and [rel](/x) or <' || url || '> end ' || url"


@query("visible_text", f"""
    select page_id, regexp_replace(regexp_replace(t, '\\[([^\\]]*)\\]\\((https?://[^)]+)\\)', '\\1', 'g'), '<?https?://[^\\s<>]+>?', '', 'g') as visible,
      regexp_replace(t, '\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g') as labels from (select page_id, {LINKED} as t from pages)""")
def _(i):
    rows = i.table("pages").select("page_id", F.expr(LINKED).alias("t"))
    return rows.select("page_id", tx.visible_text("t").alias("visible"), tx.label_text("t").alias("labels"))


@query("inline_links", """
    select page_id, 0 as index, 'page ' || page_id as label, url from pages union all select page_id, 1, 'again', url || '2' from pages""")
def _(i):
    text = F.concat(F.lit("[page "), F.col("page_id").cast("string"), F.lit("]("), "url", F.lit(") [x](mailto:a) [again]("), "url", F.lit("2)"))
    rows = i.table("pages").select("page_id", F.explode(tx.inline_links(text)).alias("l"))
    return rows.select("page_id", "l.index", "l.label", "l.url")


@query("redacted_parameters", """
    select page_id, url || '&API_KEY=[REDACTED]&x=1' as u from pages""")
def _(i):
    return i.table("pages").select("page_id", tx.redact_parameters(F.concat("url", F.lit("&API_KEY=abc123&x=1"))).alias("u"))


SECRET_JSON = "'{\"token\":\"t\",\"a\":[{\"Password\":1,\"u\":\"http://h/?token=z&y=' || cast(event_id as string) || '\"}],\"b\":{\"login\":{\"x\":1},\"k\":' || cast(user_id as string) || '}}'"


@query("sanitized_payloads", """
    select event_id, '{"a":[{"u":"http://h/?token=[REDACTED]&y=' || event_id || '"}],"b":{"k":' || user_id || '}}' as payload from events""")
def _(i):
    return payloads.sanitized(i.table("events").select("event_id", F.expr(SECRET_JSON).alias("payload")), "payload")


JSON_VALUE = "case event_id % 8 when 0 then '7' when 1 then '\"7\"' when 2 then 'true' when 3 then '1.5' when 4 then 'null' when 5 then '{\"x\":1}' when 6 then '[1]' else '\" txt \"' end"


@query("conservative_json_values", """
    select event_id, case when event_id % 8 = 0 then 7 end as number, case event_id % 8 when 1 then '7' when 7 then ' txt ' end as string_value,
      case event_id % 8 when 0 then '7' when 1 then '7' when 3 then '1.5' when 7 then 'txt' end as scalar, event_id % 8 = 5 as is_object, event_id % 8 = 6 as is_list,
      '{"k":' || (props->>'$.k') || ',"v":' || case event_id % 8 when 0 then '7' when 1 then '"7"' when 2 then 'true' when 3 then '1.5' when 4 then 'null' when 5 then '{"x":1}' when 6 then '[1]' else '" txt "' end || '}' as canonical,
      case when event_id % 8 = 6 then 1 else 0 end as length from events""")
def _(i):
    doc = F.concat(F.lit('{"v": '), F.expr(JSON_VALUE), F.lit(', "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    rows = i.table("events").withColumn("d", jsonx.parse(doc))
    return rows.select(
        "event_id", jsonx.integer("d", "$.v").alias("number"), jsonx.text("d", "$.v").alias("string_value"),
        jsonx.scalar_text("d", "$.v").alias("scalar"), jsonx.is_object("d", "$.v").alias("is_object"),
        jsonx.is_list("d", "$.v").alias("is_list"), jsonx.canonical("d").alias("canonical"),
        jsonx.array_length(F.expr(JSON_VALUE)).alias("length"),
    )


@query("table_cells_as_text", """
    select o_orderkey, case o_orderkey % 4 when 0 then 'k | ' || o_orderkey || chr(10) || ' | True' when 3 then o_orderstatus end as cells from orders""")
def _(i):
    doc = F.expr("""case o_orderkey % 4 when 0 then concat('[["k",', o_orderkey, '],[null,true]]') when 1 then '[["a"],["b","c"]]'
        when 2 then '[["a",{"x":1}]]' else concat('[["', o_orderstatus, '"]]') end""")
    return i.table("orders").select("o_orderkey", jsonx.table_text(jsonx.parse(doc)).alias("cells"))


@query("pointer_lookup", """
    select k, case k % 4 when 0 then 'Page ' || k when 1 then 'organic' end as value from src_page_parts""")
def _(i):
    doc = jsonx.parse(F.concat(F.lit('{"a/b":[{"x~y":1},'), "item0", F.lit("]}")))
    pointer = F.expr("case k % 4 when 0 then '/a~1b/1/title' when 1 then '/a~1b/1/type' when 2 then '/a~1b/0/x~0y' else '/a~1b/7' end")
    rows = i.bind("src_page_parts").select("k", doc.alias("d"), pointer.alias("p"))
    return rows.select("k", release.pointer_value("d", "p").alias("value"))


@query("display_labels", "select doc_id, coalesce(case when doc_id % 3 = 0 then null else lang end, 'Unknown (not recorded)') as label from documents")
def _(i):
    return i.table("documents").select("doc_id", tx.display(F.expr("case when doc_id % 3 = 0 then null else lang end")).alias("label"))


# ---------------------------------------------------------------------------
# Term spans
# ---------------------------------------------------------------------------

step("o_term_rows", """
    select distinct brand_id as identity, replace(lower(trim(alias_text)), 'ß', 'ss') as needle, length(replace(lower(trim(alias_text)), 'ß', 'ss')) as w
    from o_aliases where alias_text is not null and not regexp_matches(lower(alias_text), 'to_be_verified|example|placeholder|sanitized')""")
# Original position of every folded character: ß is the one letter of these texts that folds to two.
ORIGINS = "flatten(list_transform(string_split(lower(text), ''), lambda c, i: case when c = 'ß' then [i - 1, i - 1] else [i - 1] end))"
step("o_folded_documents", f"select doc_id, text, replace(lower(text), 'ß', 'ss') as f, {ORIGINS} as origin from documents")
SPAN_SQL = r"""
    with hits as (select d.*, t.* from o_folded_documents d join o_term_rows t on contains(d.f, t.needle)),
    pos as (select *, unnest(generate_series(1, len(parts) - 1)) as j from (select *, string_split(f, needle) as parts from hits)),
    starts as (select *, list_sum(list_transform(parts[1:j], lambda x: length(x)))::int + (j - 1)::int * w::int as p from pos),
    c as (select distinct doc_id, text, identity, origin[p + 1]::int as s, origin[p + w]::int + 1 as e from starts where (p = 0 or not regexp_matches(substr(f, p, 1), '[\p{L}\p{N}_]')) and (p + w >= length(f) or not regexp_matches(substr(f, p + w + 1, 1), '[\p{L}\p{N}_]'))),
    l as (select doc_id, any_value(text) as text, list({'w': s - e, 's': s, 'i': identity, 'e': e} order by s - e, s, identity) as cands from c group by doc_id),
    k as (select doc_id, text, unnest(list_reduce(list_transform(cands, lambda x: [x]), lambda acc, x: case when len(list_filter(acc, lambda o: x[1].s < o.e and o.s < x[1].e and not (x[1].s = o.s and x[1].e = o.e))) > 0 then acc else list_concat(acc, x) end)) as r from l)
    select doc_id, r.i as identity, r.s as span_start, r.e as span_end, substr(text, r.s + 1, r.e - r.s) as matched_text from k"""


def span_terms(i: Inputs) -> DataFrame:
    return term_table(st.usable_aliases(aliases(i)), "brand_id", "alias_text")


def spans(i: Inputs, **options) -> DataFrame:
    docs = i.table("documents").select("doc_id", "text")
    found = match_spans(docs, ["doc_id"], "text", span_terms(i), **options)
    return found.select("doc_id", "identity", "span_start", "span_end", "matched_text")


@query("term_spans", SPAN_SQL)
def _(i):
    return spans(i)


@query("term_spans_by_anchor_join", SPAN_SQL)
def _(i):
    return spans(i)


# ---------------------------------------------------------------------------
# Search payloads
# ---------------------------------------------------------------------------


def pages(i: Inputs) -> DataFrame:
    df = i.bind("src_page_payloads").withColumn("payload", jsonx.parse("payload_text"))
    return payloads.with_status(payloads.unwrap(df, "payload"))


step("o_pages", """
    select *, case when shape = 'none' then 'quarantined' when state = 'error' then 'provider_error' when state = 'pending' then 'pending' when state in ('nothing', 'broken') then 'quarantined' when state = 'empty' then 'no_results' else 'available' end as status
    from src_page_parts""")


@query("envelope_families", "select k, case when shape = 'none' then null else shape end as family from src_page_parts")
def _(i):
    df = i.bind("src_page_payloads").withColumn("payload", jsonx.parse("payload_text"))
    return payloads.unwrap(df, "payload").select("k", "family")


@query("incremental_envelope_families", "select k, case shape when 'none' then null when 'live_advanced' then null else shape end as family from src_page_parts")
def _(i):
    df = i.bind("src_page_payloads").withColumn("payload", jsonx.parse("payload_text"))
    return payloads.unwrap(df, "payload", payloads.INCREMENTAL_ENVELOPES).select("k", "family")


@query("provider_statuses", """
    select k, status as provider_status, case when shape = 'none' then 'unsupported_envelope' when state = 'nothing' then 'missing_result' when state = 'broken' then 'malformed_result' end as status_problem from o_pages""")
def _(i):
    return pages(i).select("k", "provider_status", "status_problem")


@query("request_contexts", """
    select k, 'organic' as search_type, case when shape = 'none' or c % 5 = 0 then '2840' else cast(2000 + c % 5 as string) end as location_code, 'en' as language_code,
      case when shape = 'none' or c % 4 = 0 then 'desktop' else 'mobile' end as device from src_page_parts""")
def _(i):
    return payloads.request_context(pages(i)).select("k", "search_type", "location_code", "language_code", "device")


def observed_pages(i: Inputs, **options) -> DataFrame:
    df = payloads.request_context(pages(i)).select(
        "*", F.concat(F.lit("q"), (F.col("c") % 20).cast("string")).alias("query_id"), F.lit("northwind").alias("provider"),
        F.expr("case c % 3 when 0 then 'Google' when 1 then 'bing' else 'baidu' end").alias("search_engine"),
        F.lit("w1").alias("collection_window"), F.concat(F.lit("r"), F.col("k").cast("string")).alias("response_id"),
        F.md5(F.col("k").cast("string")).alias("raw_file_hash"),
    )
    return payloads.search_observations(df, **options)


BASE_ID = "'q' || c % 20 || '|northwind|' || case c % 3 when 0 then 'google' when 1 then 'bing' else 'baidu' end || '|organic|' || case when shape = 'none' or c % 5 = 0 then '2840' else cast(2000 + c % 5 as string) end || '|en|' || case when shape = 'none' or c % 4 = 0 then 'desktop' else 'mobile' end || '|w1'"
step("o_observed", f"""
    select *, {duck_uuid5(BASE_ID)} as base_id, {duck_uuid5("'raw-full|' || " + duck_uuid5(BASE_ID) + " || '|r' || k || '|' || md5(cast(k as string))")} as observation_id,
      case when shape = 'none' then 'malformed_payload' when state = 'broken' then 'malformed_result' end as payload_problem,
      shape <> 'none' and state in ('items', 'error', 'pending') as has_results from o_pages""")


@query("search_observations", """
    select k, observation_id, has_results, payload_problem, case when status in ('pending', 'provider_error') then status when payload_problem is not null then 'quarantined' when has_results then 'available' else 'no_results' end as outcome_status from o_observed""")
def _(i):
    return observed_pages(i).select("k", "observation_id", "has_results", "payload_problem", "outcome_status")


@query("search_observations_by_window", "select k, base_id as observation_id, case when has_results then 'available' else 'no_results' end as outcome_status from o_observed")
def _(i):
    return observed_pages(i, rekeyed=False).select("k", "observation_id", "outcome_status")


step("o_page_items", f"""
    select k, c, observation_id, 0 as item_index, 'organic' as kind, 1 as rg, case when k % 3 = 0 then null else k % 3 end as ra, nullif('Brand' || (c % 30) || '.Shop.', case when c % 3 = 0 then 'Brand' || (c % 30) || '.Shop.' end) as dom,
      'HTTPS://WWW.Brand' || (c % 30) || '.Shop:443/p?x=' || k || '#f' as u, 'https://www.brand' || (c % 30) || '.shop:443/p?x=' || k as canon, 'Page ' || k as title, case when k % 3 = 0 then 'invalid_rank' end as warn, item0 as raw from o_observed where has_results
    union all select k, c, observation_id, 1, case k % 5 when 0 then 'featured_snippet' when 1 then 'mystery' else 'organic' end, case when k % 5 = 4 then null else 2 end, case when k % 5 = 4 then null else 2 end, null,
      case k % 5 when 0 then 'http://a_b.example/x y' when 1 then 'ftp://h/x' end, case k % 5 when 0 then 'http://a_b.example/x y' end, null, case k % 5 when 1 then 'unknown_item_type' when 4 then 'invalid_rank' end, item1 from o_observed where has_results and k % 5 in (0, 1, 4)""")


@query("serp_items", f"""
    select {duck_uuid5("observation_id || '|' || item_index || '|' || raw")} as serp_item_id, observation_id, item_index, kind as raw_item_type, case when kind = 'mystery' then 'unknown' else kind end as normalized_item_type, rg as rank_group, ra as rank_absolute,
      dom as raw_domain, case when dom is not null then rtrim(lower(dom), '.') when u like 'HTTPS%' then 'www.brand' || (c % 30) || '.shop' when u like 'http:%' then 'a_b.example' when u like 'ftp%' then 'h' end as normalized_domain,
      u as raw_url, canon as canonical_url, title, case when warn is null then 'normalized' else 'warning' end as normalization_status, warn as parsing_warning from o_page_items""")
def _(i):
    found = payloads.serp_items(payloads.raw_items(observed_pages(i)))
    return found.select(
        "serp_item_id", "observation_id", "item_index", "raw_item_type", "normalized_item_type", "rank_group", "rank_absolute",
        "raw_domain", "normalized_domain", "raw_url", "canonical_url", "title", "normalization_status", "parsing_warning",
    )


@query("serp_quarantine", f"""
    with q as (select observation_id, null as item_index, payload_problem as reason, null as raw from o_observed where payload_problem is not null
      union all select observation_id, item_index, warn, raw from o_page_items where warn is not null
      union all select observation_id, 1, 'malformed_item', item1 from o_observed where has_results and k % 5 in (2, 3))
    select {duck_uuid5("observation_id || '|' || coalesce(cast(item_index as string), 'None') || '|' || reason || '|' || coalesce(raw, 'None')")} as quarantine_id, observation_id, item_index, reason, raw as raw_item_json from q""")
def _(i):
    seen = observed_pages(i)
    return payloads.serp_quarantine(seen, payloads.raw_items(seen)).select(
        "quarantine_id", "observation_id", "item_index", "reason", "raw_item_json"
    )


@query("generic_engine_quarantine", """
    select observation_id, item_index, reason from (select observation_id, null as item_index, payload_problem as reason from o_observed where payload_problem is not null
      union all select observation_id, item_index, warn from o_page_items where warn is not null union all select observation_id, 1, 'malformed_item' from o_observed where has_results and k % 5 in (2, 3))""")
def _(i):
    seen = observed_pages(i)
    return payloads.serp_quarantine(seen, payloads.raw_items(seen), single=True).select("observation_id", "item_index", "reason")


@query("organic_feature_rows", """
    select observation_id, item_index, ra as engine_rank from o_page_items where kind = 'organic' and ra is not null and c % 3 < 2""")
def _(i):
    seen = observed_pages(i)
    found = payloads.serp_items(payloads.raw_items(seen))
    rows = payloads.organic_results(found, seen).select("observation_id", F.col("parent_serp_item_id").alias("serp_item_id"), "engine_rank")
    return rows.join(growing(found.select("serp_item_id", "item_index")), "serp_item_id").select("observation_id", "item_index", "engine_rank")


@query("feature_capabilities", """
    select observation_id, c % 3 < 2 as feature_supported, c % 3 < 2 and p.k is not null as feature_observed from o_observed o left join (select distinct k from o_page_items where kind = 'organic' and ra is not null) p using (k)""")
def _(i):
    # Observations are read three times; payloads are parsed once.
    seen = i.once("observed", lambda: observed_pages(i).drop("payload_text", "payload", "item0", "item1", "task", "data"))
    rows = payloads.organic_results(payloads.serp_items(payloads.raw_items(seen)), seen)
    return payloads.feature_capability(seen, rows).select("observation_id", "feature_supported", "feature_observed")


# ---------------------------------------------------------------------------
# Answer payloads
# ---------------------------------------------------------------------------


def flat_answers(i: Inputs) -> DataFrame:
    df = i.bind("src_answer_payloads").withColumn("payload", jsonx.parse("payload_text"))
    return payloads.flatten_answers(df)


ANSWER_TEXT = "trim(replace(text, chr(92), ''))"


@query("flattened_answers", f"""
    select a.request_id, case doc_id % 10 when 0 then 'missing_retrieval' when 1 then 'missing_tasks' when 2 then 'missing_results' when 3 then 'multiple_tasks' end as answer_problem,
      case when doc_id % 10 > 3 then 'chat_gpt' else 'unknown' end as platform, 'unknown' as model_name, case when doc_id % 10 > 3 then 'kw' || doc_id end as query_text, case when doc_id % 10 > 3 then 't' || doc_id end as task_id,
      case when doc_id % 10 > 3 then 20000 end as status_code, case when doc_id % 10 > 3 then 0.25::double end as cost, case when doc_id % 10 > 3 then lang end as language_code, case when doc_id % 10 > 3 then '2840' end as location_code,
      case when doc_id % 10 > 3 then 2 else 0 end as items_count, case when doc_id % 10 = 4 then 'whole' when doc_id % 10 > 4 then {ANSWER_TEXT} || chr(10) || chr(10) || 'second part' end as response_text
    from (select request_id, doc_id from src_answer_payloads) a join documents using (doc_id)""")
def _(i):
    return flat_answers(i).select(
        "request_id", "answer_problem", "platform", "model_name", "query_text", "task_id", "status_code", "cost",
        "language_code", "location_code", "items_count", "response_text",
    )


@query("answer_observations", f"""
    select {duck_uuid5("request_id || '|' || response_id || '|' || raw_file_hash || '|llm'")} as observation_id, request_id, case when doc_id % 10 > 3 then 'available' else 'quarantined' end as outcome_status,
      case when doc_id % 10 > 3 then 1 else 0 end as citation_count from src_answer_payloads""")
def _(i):
    return payloads.answer_observations(flat_answers(i)).select(
        "observation_id", "request_id", "outcome_status", jsonx.array_length("citations_json").alias("citation_count")
    )


@query("answer_items", f"""
    select 'q' || doc_id as request_id, 0 as index, 'gemini_text' as item_type, 1 as rank_group, {ANSWER_TEXT} as text, '$.retrieval.tasks[0].result[0].items[0]' as json_path, 1 as source_count from documents where doc_id % 10 > 3
    union all select 'q' || doc_id, 2, 'unknown', null, 'second part', '$.retrieval.tasks[0].result[0].items[2]', 0 from documents where doc_id % 10 > 3""")
def _(i):
    return payloads.answer_items(flat_answers(i)).drop("rank_absolute")


# ---------------------------------------------------------------------------
# Evidence trees
# ---------------------------------------------------------------------------


def tree_payloads(i: Inputs) -> DataFrame:
    return i.bind("src_tree_payloads").withColumn("payload", jsonx.parse("payload_text")).drop("payload_text")


def results(i: Inputs) -> DataFrame:
    return i.once("results", lambda: evidence.result_rows(tree_payloads(i)))


def nodes(i: Inputs) -> DataFrame:
    return i.once("nodes", lambda: evidence.collect_nodes(results(i)))


def dated(df: DataFrame, i: Inputs) -> DataFrame:
    if "collected_at" in df.columns:
        return df
    days = i.bind("src_tree_payloads").select("observation_id", "collected_at")
    return df.join(growing(days), "observation_id")


def tree_items(i: Inputs) -> DataFrame:
    """Items of the stored nodes: every branch of a query reads the columns it needs."""
    return tree.feature_items(nodes(i))


def fresh_nodes(i: Inputs) -> DataFrame:
    """Nodes for queries that use them once: nothing is stored."""
    return evidence.collect_nodes(evidence.result_rows(tree_payloads(i)))


def fresh_items(i: Inputs) -> DataFrame:
    return tree.feature_items(fresh_nodes(i))


def issues(i: Inputs) -> DataFrame:
    n = nodes(i)
    return evidence.node_issues(n).unionByName(evidence.result_issues(results(i), n))


def coverage(i: Inputs) -> DataFrame:
    return i.once("coverage", lambda: evidence.feature_coverage(results(i), tree_items(i), issues(i)))


R = "'$.retrieval.tasks[0].result[0]'"
RESULT_ID = duck_evidence_id("'obs' || k", f"case when collection_status = 'pending' then '$.retrieval' else {R} end", "'feature-evidence-2'")
step("o_tree", f"select *, {RESULT_ID} as result_id, c % 7 <> 0 as listed, source_category = 'serp' as serp from src_tree_payloads")
step("o_nodes", f"""
    with t as (select *, {R} as b, case when serp then '.items[3].items[0]' else '.items[0]' end as ans, case when serp then '.items[2]' else '.items[1]' end as prod from o_tree where collection_status <> 'pending'),
    l as (select * from t where listed)
    select k, c, b || '.items[0]' as path, null as parent, 'organic' as kind, true as top from l where serp
    union all select k, c, b || '.items[0].images[' || n || ']', b || '.items[0]', 'image', false from l, (values (0), (1)) v(n) where serp and c % 6 = 0
    union all select k, c, b || '.items[1]', null, case when c % 3 = 0 then 'organic' else 'paid' end, true from l where serp
    union all select k, c, b || '.items[1].links[' || n || ']', b || '.items[1]', case n when 0 then 'ad_link' else 'unsupported' end, false from l, (values (0), (1)) v(n) where serp and c % 3 = 1
    union all select k, c, b || prod, null, 'product_module', true from l
    union all select k, c, b || prod || '.items[' || n || ']', b || prod, 'product', false from l, (values (0), (1)) v(n) where c % 4 in (2, 3)
    union all select k, c, b || prod || '.items[1].spec' || s, b || prod || '.items[1]' || p, 'retained_nested', false from l, (values ('', ''), ('.deep', '.spec'), ('.deep.z', '.spec.deep')) v(s, p) where c % 8 = 3
    union all select k, c, b || '.items[3]', null, 'answer_module', true from l where serp
    union all select k, c, b || ans, case when serp then b || '.items[3]' end, 'answer_text', not serp from l
    union all select k, c, b || '.items[3].items[1]', b || '.items[3]', 'unsupported', false from l where serp and c % 9 = 0
    union all select k, c, b || '.items[3].references[0]', b || '.items[3]', 'citation', false from l where serp
    union all select k, c, b || ans || '.sources[' || n || ']', b || ans, 'citation', false from l, (values (0), (1)) v(n) where c % 8 <> 1 and (n = 0 or c % 8 = 0)
    union all select k, c, b || ans || '.markdown.inline_links[' || n || ']', b || ans, 'citation', false from l, (values (0), (1)) v(n)
    union all select k, c, b || '.items[2]', null, case when c % 5 = 2 then 'unsupported' else 'answer_text' end, true from l where not serp
    union all select k, c, b || '.items[3]', null, 'unsupported', true from l where not serp and c % 11 = 5
    union all select k, c, b || '.sources[' || n || ']', null, 'citation', false from t, (values (0), (1)) v(n) where c % 4 = 0
    union all select k, c, b || '.markdown', null, 'answer_text', false from t where not serp and c % 14 = 0""")


@query("evidence_tree", f"""
    select {duck_evidence_id("'obs' || k", 'path', "'feature-evidence-2'")} as item_id, case when parent is not null then {duck_evidence_id("'obs' || k", 'parent', "'feature-evidence-2'")} end as parent_item_id,
      'obs' || k as observation_id, path as json_path, kind as item_kind, top as is_top_level from o_nodes""")
def _(i):
    return fresh_nodes(i).select("item_id", "parent_item_id", "observation_id", "json_path", "item_kind", "is_top_level")


@query("unexpanded_nodes", "select 'x' as observation_id, 'x' as item_id, 'x' as json_path where false")
def _(i):
    return tree.unexpanded_nodes(nodes(i))


@query("evidence_items", """
    select 'obs' || k as observation_id, path as json_path, kind as item_kind, case when kind = 'organic' and (path like '%items[0]') then 1 + c % 4 end as organic_rank,
      case when kind = 'answer_text' then case when path like '%.markdown' then 'fallback Brand' || (c % 25) when path like '%items[2]' then case c % 5 when 0 then 'a | 1' || chr(10) || 'b | ' when 1 then null else 'plain words' end
        else 'See Brand' || (c % 25) || ' and again or  now' end end as normalized_text,
      case when kind = 'answer_text' then case when path like '%items[2]' then case c % 5 when 0 then 'scalar_table_cells' when 1 then null else 'text' end else 'markdown' end end as text_method,
      case when kind = 'unsupported' or (kind = 'answer_text' and path like '%items[2]' and c % 5 = 1) or (kind = 'citation' and path like '%.sources[1]' and path like '%items%') or (kind = 'product' and path like '%items[1]' and c % 8 = 3)
        or (kind = 'retained_nested' and path not like '%.z') then 'partial' else 'complete' end as coverage_status from o_nodes""")
def _(i):
    return fresh_items(i).select("observation_id", "json_path", "item_kind", "organic_rank", "normalized_text", "text_method", "coverage_status")


step("o_coverage", """
    with f as (select *, unnest(['organic', 'paid', 'answer_text', 'product', 'citation']) as feature from o_tree),
    st as (select *, case when collection_status = 'pending' then 'pending'
      when serp then case feature when 'organic' then case when not listed or c % 3 = 0 then 'partial' else 'complete' end
          when 'paid' then case when not listed or c % 3 <> 0 then 'partial' else 'complete' end
          when 'product' then case when not listed or c % 4 < 2 or c % 8 = 3 then 'partial' else 'complete' end
          when 'answer_text' then case when not listed then 'not_applicable' when c % 9 = 0 then 'partial' else 'complete' end
          else case when not listed then 'not_applicable' when c % 8 < 2 or c % 4 = 1 then 'partial' else 'complete' end end
      else case feature when 'organic' then 'not_applicable' when 'paid' then 'not_applicable'
          when 'answer_text' then case when c % 14 = 0 then 'complete' when not listed or c % 11 = 5 or c % 5 in (1, 2) then 'partial' else 'complete' end
          when 'product' then case when not listed or c % 4 < 2 or c % 8 = 3 or c % 11 = 5 or c % 5 = 2 then 'partial' else 'complete' end
          else case when listed and c % 8 = 4 and c % 5 in (0, 3, 4) and c % 11 <> 5 then 'complete' else 'partial' end end end as coverage_status,
      case feature when 'organic' then case when serp and listed then 1 + (c % 3 = 0)::int else 0 end when 'paid' then (serp and listed and c % 3 <> 0)::int
        when 'product' then case when listed and c % 4 > 1 then 2 else 0 end when 'answer_text' then case when serp then listed::int when listed then 1 + (c % 5 in (0, 3, 4))::int else (c % 14 = 0)::int end
        else (listed and serp)::int + (listed and c % 8 <> 1)::int + listed::int + (c % 4 = 0)::int end as n from f)
    select *, case when coverage_status in ('complete', 'partial') then n end as observed_count, case when coverage_status = 'complete' then n end as exhaustive_count from st""")


@query("feature_coverage", f"""
    select {duck_evidence_id('result_id', 'feature')} as feature_id, observation_id, result_id, feature, coverage_status, observed_count, exhaustive_count from o_coverage""")
def _(i):
    return coverage(i).select("feature_id", "observation_id", "result_id", "feature", "coverage_status", "observed_count", "exhaustive_count")


@query("citation_coverage_issues", """
    with t as (select *, '$.retrieval.tasks[0].result[0]' as b, case when serp then '.items[3].items[0]' else '.items[0]' end as ans from o_tree)
    select observation_id, 'citation' as feature, b || ans || '.sources[1]:invalid_or_missing_url' as issue from t where collection_status <> 'pending' and listed and c % 8 = 0
    union all select observation_id, 'citation', b || ans || '.sources:sources_unavailable' from t where collection_status <> 'pending' and listed and c % 8 = 1
    union all select observation_id, 'citation', b || '.sources:sources_unavailable' from t where collection_status <> 'pending' and c % 4 = 1
    union all select observation_id, 'citation', case when collection_status = 'pending' then '$.retrieval' else b end || ':result_sources_missing' from t where not serp and (collection_status = 'pending' or c % 4 > 1)
    union all select observation_id, 'citation', 'no_explicit_source_container' from t where not serp and (collection_status = 'pending' or (c % 4 > 1 and not listed))
    union all select observation_id, 'citation', 'items_unavailable' from t where not serp and (collection_status = 'pending' or not listed)
    union all select observation_id, 'citation', b || '.items[2]:sources_missing' from t where collection_status <> 'pending' and not serp and listed and c % 5 = 1
    union all select observation_id, 'citation', b || '.markdown:sources_missing' from t where collection_status <> 'pending' and not serp and c % 14 = 0
    union all select observation_id, 'citation', b || '.items[2]:unknown_llm_item' from t where collection_status <> 'pending' and not serp and listed and c % 5 = 2
    union all select observation_id, 'citation', b || '.items[3]:unknown_llm_item' from t where collection_status <> 'pending' and not serp and listed and c % 11 = 5""")
def _(i):
    return issues(i).filter("feature = 'citation'").select("observation_id", "feature", "issue")


step("o_occurrences", """
    select k, c, path, case when path like '%references[0]' then 'https://brand3.shop/r' when path like '%inline_links%' then 'https://brand' || (c % 30) || '.shop/q?a=1'
      when path like '%.result[0].sources[%' then 'https://brand4.shop/s' when path like '%.sources[0]' then 'https://brand1.shop/' end as canonical_url from o_nodes where kind = 'citation'""")


@query("citation_occurrences", "select 'obs' || k as observation_id, path as json_path, canonical_url from o_occurrences")
def _(i):
    return evidence.citation_occurrences(fresh_items(i)).select("observation_id", "json_path", "canonical_url")


@query("citation_entities", """
    select distinct 'obs' || k as observation_id, canonical_url, regexp_extract(canonical_url, '//([^/]+)/', 1) as domain from o_occurrences where canonical_url is not null""")
def _(i):
    return evidence.citations(evidence.citation_occurrences(fresh_items(i))).select("observation_id", "canonical_url", "domain")


@query("product_brand_candidates", """
    select 'obs' || k as observation_id, 'candidate-' || substr(sha256('acme' || (c % 9)), 1, 24) as candidate_id, 'Acme' || (c % 9) as candidate_name, ' Acme' || (c % 9) || ' ' as matched_text
    from o_nodes where kind = 'product' and path like '%.items[0]'""")
def _(i):
    return payloads.explicit_brands(fresh_items(i)).select("observation_id", "candidate_id", "candidate_name", "matched_text")


# --- matches --------------------------------------------------------------------------------------

step("o_ok_brands", "select * from o_brands where active and lower(ownership_type) in ('owned', 'competitor') and not coalesce(regexp_matches(lower(canonical_name), 'to_be_verified|example|placeholder|sanitized|範例|示例'), false)")
VALID = "(b.effective_start_date is null or t.collected_at >= b.effective_start_date) and (b.effective_end_date is null or t.collected_at <= b.effective_end_date)"
step("o_text_hits", f"""
    select n.k, n.path, b.brand_id, case n.kind when 'organic' then 'organic_title_snippet' when 'product' then 'product_text' else 'answer_text' end as evidence_type, case when n.kind = 'answer_text' then 'text' else 'title' end as matched_field,
      case when n.kind <> 'answer_text' then 0 when n.path like '%.markdown' then 9 else 4 end as span_start
    from o_nodes n join o_tree t using (k) join o_ok_brands b on b.brand_id = 'brand' || (n.c % 25) and b.canonical_name is not null and {VALID}
    where (n.kind = 'organic' and n.path like '%items[0]') or (n.kind = 'product' and n.path like '%.items[0]') or (n.kind = 'answer_text' and (n.path like '%.markdown' or n.path not like '%items[2]'))""")
step("o_owned_hits", f"""
    with u as (select k, c, path, case kind when 'organic' then 'owned_organic' else 'paid_domain' end as evidence_type, case when path like '%links[0]' then 'brand2.shop' else 'brand' || (c % 30) || '.shop' end as host, null as canonical_url
        from o_nodes where (kind = 'organic' and path like '%items[0]') or kind in ('paid', 'ad_link')
      union all select k, c, path, 'owned_citation', regexp_extract(canonical_url, '//([^/]+)/', 1), canonical_url from o_occurrences where canonical_url is not null)
    select u.*, b.brand_id from u join o_tree t using (k) join o_domains d on lower(trim(d.domain)) = u.host join o_ok_brands b on b.brand_id = d.brand_id and {VALID}""")


step("o_feature_fields", """
    select *, 'title' as field, case when kind = 'ad_link' then 'L' when kind = 'paid' then 'Ad' when path like '%.items[0]' then 'Brand' || (c % 25) || case kind when 'organic' then ' gear' else ' shoe' end when kind = 'product' then 'y' else 'x' end as txt,
      case kind when 'organic' then 'organic_title_snippet' when 'product' then 'product_text' else 'paid_text' end as evidence_type from o_nodes where kind in ('organic', 'paid', 'ad_link', 'product')
    union all select *, 'brand', ' Acme' || (c % 9) || ' ', 'product_text' from o_nodes where kind = 'product' and path like '%.items[0]'
    union all select *, 'text', case when path like '%.markdown' then 'fallback Brand' || (c % 25) when path like '%items[2]' then case c % 5 when 0 then 'a | 1' when 1 then '' else 'plain words' end else 'See Brand' || (c % 25) || ' and again or  now' end,
      'answer_text' from o_nodes where kind = 'answer_text'""")
step("o_category_hits", """
    select f.k, f.path, f.evidence_type, w.category_id, w.rule_id
    from o_feature_fields f join (select *, lower(trim(term)) as needle from src_response_rules where review_status = 'approved' and lower(active) = 'true') w
      on f.field = case when f.kind = 'answer_text' and w.matched_field in ('original_text', 'markdown') then 'text' else w.matched_field end
      and w.item_kind in ('*', f.kind, case f.kind when 'product' then 'product_card' when 'answer_text' then 'answer_block' end)
      and regexp_split_to_array(lower(trim(f.txt)), '[^a-z0-9]+')::varchar like '%' || array_to_string(string_split(w.needle, ' '), ', ') || '%' and list_has_all(regexp_split_to_array(lower(trim(f.txt)), '[^a-z0-9]+'), string_split(w.needle, ' '))""")


def text_matches(i: Inputs, items: DataFrame | None = None) -> DataFrame:
    registry = brands(i)
    names = st.eligible_brand_rows(registry).select(F.col("brand_id").alias("identity_id"), F.col("canonical_name").alias("identity_name"))
    texts = evidence.item_texts(dated(tree_items(i) if items is None else items, i))
    return evidence.brand_matches(texts, evidence.brand_terms(registry, st.usable_aliases(aliases(i))), names, "brand", "approved", as_of="collected_at")


def host_matches(i: Inputs, items: DataFrame | None = None) -> DataFrame:
    hosts = evidence.registered_hosts(brands(i), domains(i))
    return evidence.owned_matches(dated(tree_items(i) if items is None else items, i), hosts, as_of="collected_at")


def category_hits(i: Inputs) -> DataFrame:
    return i.once("category_hits", lambda: evidence.category_matches(evidence.item_texts(tree_items(i)), response_rules(i)))


def matches(i: Inputs) -> DataFrame:
    return i.once("matches", lambda: evidence.all_matches(
        [text_matches(i), host_matches(i), evidence.proposal_matches(tree_items(i)), category_hits(i)]
    ))


@query("brand_text_matches", "select 'obs' || k as observation_id, brand_id as identity_id, evidence_type, matched_field, span_start, span_start + length(brand_id) as span_end from o_text_hits")
def _(i):
    return text_matches(i, fresh_items(i)).select("observation_id", "identity_id", "evidence_type", "matched_field", "span_start", "span_end")


@query("owned_host_matches", "select 'obs' || k as observation_id, brand_id as identity_id, evidence_type from o_owned_hits")
def _(i):
    return host_matches(i, fresh_items(i)).select("observation_id", "identity_id", "evidence_type")


@query("all_evidence_matches", """
    select identity_type, evidence_type, count(*) as matches from (
      select 'brand' as identity_type, evidence_type, 1 from o_text_hits union all select 'brand', evidence_type, 1 from (select distinct k, evidence_type, brand_id, coalesce(canonical_url, path) from o_owned_hits)
      union all select 'brand_candidate', 'product_text', 1 from o_nodes where kind = 'product' and path like '%.items[0]' union all select 'category', evidence_type, 1 from o_category_hits) group by 1, 2""")
def _(i):
    return matches(i).groupBy("identity_type", "evidence_type").agg(F.count("*").alias("matches"))


def answer_texts(i: Inputs) -> DataFrame:
    return i.table("documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item_id"), F.lit("o").alias("observation_id"), F.lit("r").alias("result_id"),
        F.lit("answer_text").alias("item_kind"), F.lit("answer_text").alias("evidence_type"), F.lit("text").alias("matched_field"),
        F.col("text").alias("field_text"),
    )


def category_rules(i: Inputs) -> DataFrame:
    from sightline.sources.registries import approved_rules

    return approved_rules(i.bind("src_rules"))


@query("category_rule_matches", r"""
    with d as (select * from o_folded_documents), r as (select *, replace(lower(trim(term)), 'ß', 'ss') as needle from src_rules where review_status = 'approved' and lower(active) = 'true'
      and matched_field in ('text', 'markdown') and item_kind in ('*', 'answer_block') and trim(term) <> ''),
    hits as (select d.*, r.* from d join r on contains(d.f, r.needle)),
    pos as (select *, unnest(generate_series(1, len(parts) - 1)) as j from (select *, string_split(f, needle) as parts from hits)),
    s as (select *, list_sum(list_transform(parts[1:j], lambda x: length(x)))::int + (j - 1)::int * length(needle)::int as p from pos)
    select 'd' || doc_id as item_id, category_id as identity_id, 'explicit_multilabel_rule:' || rule_id as method, min(origin[p + 1])::int as span_start, arg_min(substr(text, origin[p + 1]::int + 1, (origin[p + length(needle)] - origin[p + 1])::int + 1), p) as matched_text from s
    where (p = 0 or not regexp_matches(substr(f, p, 1), '[\p{L}\p{N}_]')) and (p + length(needle) >= length(f) or not regexp_matches(substr(f, p + length(needle)::int + 1, 1), '[\p{L}\p{N}_]')) group by 1, 2, 3""")
def _(i):
    return evidence.category_matches(answer_texts(i), category_rules(i)).select("item_id", "identity_id", "method", "span_start", "matched_text")


@query("readable_items", """
    with ct as (select k, path, string_agg(distinct category_id, ',' order by category_id) as ids from o_category_hits group by 1, 2),
    nm as (select h.k, h.path, string_agg(distinct b.canonical_name, ',' order by b.canonical_name) as names from (select k, path, brand_id from o_text_hits union select k, path, brand_id from o_owned_hits) h join o_ok_brands b on b.brand_id = h.brand_id group by 1, 2)
    select 'obs' || n.k as observation_id, n.path as json_path, case when n.kind = 'product' and n.path like '%.items[0]' then 'Acme' || (n.c % 9) else '' end as candidate_brand_names, coalesce(ct.ids, 'unknown') as reviewed_category_ids,
      coalesce(nm.names, '') as approved_brand_names from o_nodes n left join nm on nm.k = n.k and nm.path = n.path left join ct on ct.k = n.k and ct.path = n.path where n.kind not in ('citation')""")
def _(i):
    context = results(i).select("result_id", "query_id", "collection_status")
    rows = features.readable_items(tree_items(i), context, matches(i))
    return rows.filter("item_kind <> 'citation'").select(
        "observation_id", "json_path", "candidate_brand_names", "reviewed_category_ids", "approved_brand_names"
    )


@query("item_view_counts", """
    select 'answer_blocks' as view, count(*) as items from o_nodes where kind = 'answer_text' union all select 'products', count(*) from o_nodes where kind = 'product'
    union all select 'serp_results', count(*) from o_nodes n join o_tree t using (k) where n.top and t.serp""")
def _(i):
    views = st.SERP_KIND_FILTERS
    counts = fresh_items(i).agg(*[F.count_if(F.expr(held)).alias(view) for view, held in views.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(v).alias("view"), F.col(v).alias("items")) for v in views])))


# --- feature measures -----------------------------------------------------------------------------

step("o_entities", """
    select k, 'answer_text' as feature, brand_id, path || matched_field || span_start as entity, null::bigint as rk from o_text_hits where evidence_type = 'answer_text'
    union all select k, 'product', brand_id, path, null from o_text_hits where evidence_type = 'product_text'
    union all select h.k, 'organic', brand_id, h.path, 1 + h.c % 4 from o_owned_hits h where evidence_type = 'owned_organic'
    union all select k, 'paid', brand_id, path, null from o_owned_hits where evidence_type = 'paid_domain' and path like '%items[1]'
    union all select distinct k, 'citation', brand_id, canonical_url, null from o_owned_hits where evidence_type = 'owned_citation'""")
step("o_all_feature_rows", f"""
    select v.*, b.brand_id, b.canonical_name, coalesce(e.n, 0) as n_own, e.rk from o_coverage v join o_ok_brands b on (b.effective_start_date is null or v.collected_at >= b.effective_start_date) and (b.effective_end_date is null or v.collected_at <= b.effective_end_date)
    left join (select k, feature, brand_id, count(*) as n, min(rk) as rk from o_entities group by 1, 2, 3) e on e.k = v.k and e.feature = v.feature and e.brand_id = b.brand_id""")
step("o_feature_rows", "select * from o_all_feature_rows where brand_id in (select brand_id from o_eligible)")


@query("feature_brand_visibility", """
    select brand_id, feature, coverage_status, count(*) as rows, sum(case when coverage_status in ('complete', 'partial') then n_own end)::bigint as observed, sum(case when coverage_status in ('complete', 'partial') and n_own > 0 then 1 when coverage_status = 'complete' then 0 end)::bigint as present,
      count(case when (coverage_status in ('complete', 'partial') and n_own > 0) or coverage_status = 'complete' then 1 end) as measured,
      sum(case when feature = 'organic' and rk <= 3 then 1 end)::bigint as top3, sum(case when feature = 'organic' and rk <= 10 then 1 end)::bigint as top10 from o_feature_rows group by 1, 2, 3""")
def _(i):
    rows = features.feature_visibility(results(i), coverage(i), matches(i), tree_items(i), brands(i))
    return rows.groupBy("brand_id", "feature", "coverage_status").agg(
        F.count("*").alias("rows"), F.sum("observed_brand_count").alias("observed"), F.sum("brand_presence").alias("present"),
        F.count("brand_presence").alias("measured"), F.sum(F.nullif("owned_top3_presence", F.lit(0))).alias("top3"),
        F.sum(F.nullif("owned_top10_presence", F.lit(0))).alias("top10"),
    )


def research(i: Inputs) -> DataFrame:
    return features.research_metrics(results(i), coverage(i), matches(i), tree_items(i), brands(i))


@query("research_metrics", """
    with own as (select k, feature, entity, count(distinct brand_id) as owners, min(brand_id) as brand_id from o_entities where feature <> 'answer_text' group by 1, 2, 3),
    ex as (select k, feature, brand_id, count(*) as n from own where owners = 1 group by 1, 2, 3),
    r as (select f.*, case when f.feature = 'answer_text' then f.n_own else coalesce(ex.n, 0) end as cnt from (select * from o_all_feature_rows where brand_id in (select brand_id from o_ok_brands where ownership_type in ('owned', 'competitor'))) f left join ex on ex.k = f.k and ex.feature = f.feature and ex.brand_id = f.brand_id)
    select brand_id, feature, coverage_status, count(*) as rows, sum(case when coverage_status in ('complete', 'partial') then cnt end)::bigint as observed,
      sum(case when coverage_status = 'complete' then (n_own > 0)::int end)::bigint as presence_numerator, sum(case when coverage_status = 'complete' then 1 end)::bigint as presence_denominator,
      sum(case when coverage_status = 'complete' and feature <> 'answer_text' then cnt end)::bigint as share_numerator, sum(case when feature <> 'answer_text' then exhaustive_count end)::bigint as share_denominator from r group by 1, 2, 3""")
def _(i):
    return research(i).groupBy("brand_id", "feature", "coverage_status").agg(
        F.count("*").alias("rows"), F.sum("observed_brand_count").alias("observed"),
        F.sum("presence_numerator").alias("presence_numerator"), F.sum("presence_denominator").alias("presence_denominator"),
        F.sum("share_numerator").alias("share_numerator"), F.sum("share_denominator").alias("share_denominator"),
    )


@query("research_summary")
def _(i):
    rows = research(i).withColumn("collection_window", F.lit("w1"))
    return presence.research_summary(rows)


def frozen(i: Inputs) -> DataFrame:
    """Contexts of the release, from metric rows of both channels with several brands each."""
    rows = i.bind("src_frozen_contexts").drop("brand_no")
    side = lambda category, instrument, source: rows.filter(F.col("source_category") == category).withColumnRenamed("instrument_id", instrument).withColumnRenamed("engine_or_platform", source)
    return release.frozen_contexts(side("serp", "query_id", "search_engine"), side("llm", "prompt_id", "platform"))


def research_rows(i: Inputs) -> DataFrame:
    context = i.once("result_context", lambda: evidence.result_context(results(i), tree_items(i), issues(i)))
    return research_snapshot.snapshot(
        "rel1", frozen(i), context, research(i), coverage(i), matches(i), i.bind("src_research_mappings"), F.lit("1998-01-01").cast("date"),
        evidence=(tree_items(i),),
    )


step("o_valid_mappings", "select * from src_research_mappings where active and effective_end_date is null")


@query("research_snapshot", """
    select 'metrics' as kind, observation_id, count(*) as rows from o_all_feature_rows where brand_id in (select brand_id from o_ok_brands where ownership_type in ('owned', 'competitor')) group by 2
    union all select 'coverage', observation_id, count(*) from o_coverage group by 2
    union all select 'candidates', 'obs' || k, count(*) from o_nodes where kind = 'product' and path like '%.items[0]' group by 2
    union all select 'needs', null, count(*) from (select distinct k, category_id, rule_id from o_category_hits)
    union all select 'mappings', null, count(*) from o_valid_mappings
    union all select 'pairs', s.observation_id, count(*) from o_valid_mappings m join (select * from src_frozen_contexts where brand_no = 1 and source_category = 'serp') s on s.instrument_id = m.query_id
      join (select * from src_frozen_contexts where brand_no = 1 and source_category = 'llm') a on a.instrument_id = m.prompt_id and a.language_code = s.language_code and a.location_code = s.location_code and a.collection_window = s.collection_window group by 2""")
def _(i):
    found = F.nullif(F.regexp_extract("payload_json", r'"(?:serp_)?observation_id": "([^"]*)"', 1), F.lit(""))
    return research_rows(i).groupBy("kind", found.alias("observation_id")).agg(F.count("*").alias("rows"))


@query("research_mapping_rows", f"""
    with p as (select '{{"active": true, "comparison_id": "' || comparison_id || '", "effective_end_date": null, "effective_start_date": "1997-01-01", "mapping_version": "' || mapping_version || '", "prompt_id": "' || prompt_id || '", "query_id": "' || query_id || '"}}' as payload_json from o_valid_mappings)
    select {duck_uuid5("'[\"mappings\", \"' || replace(payload_json, '\"', '\\\"') || '\"]'")} as row_id, payload_json from p""")
def _(i):
    return research_rows(i).filter("kind = 'mappings'").select("row_id", "payload_json")


@query("frozen_contexts", "select * exclude (brand_no) from src_frozen_contexts where brand_no = 1")
def _(i):
    return frozen(i)


@query("result_contexts", """
    select observation_id, result_id, case when collection_status = 'pending' then case when true then 'zh-cn' end when c % 3 = 0 then 'zh-cn' else 'en-gb' end as language_code, case when collection_status = 'pending' then '2840' else '2276' end as location_code,
      'kw' as query_text, 10 as request_depth, collection_status, case when collection_status <> 'pending' and listed then case when serp then 4 else 3 + (c % 11 = 5)::int end end as top_level_item_count,
      case when collection_status <> 'pending' then 4 end as provider_reported_item_count, case when collection_status <> 'pending' and listed then coalesce(g.n, 0) end as parsed_top_level_item_count
    from o_tree left join (select k, count(*) as n from o_nodes n where n.top and n.kind <> 'unsupported' and not (n.kind = 'answer_text' and n.path like '%items[2]' and n.c % 5 = 1) group by 1) g using (k)""")
def _(i):
    rows = evidence.result_context(results(i), tree_items(i), issues(i))
    return rows.select(
        "observation_id", "result_id", "language_code", "location_code", "query_text", "request_depth", "collection_status",
        "top_level_item_count", "provider_reported_item_count", "parsed_top_level_item_count",
    )


# --- first-generation evidence -------------------------------------------------------------------


def response_rows(i: Inputs) -> DataFrame:
    return i.once("responses", lambda: first.responses(tree_payloads(i)))


def response_parts(i: Inputs) -> DataFrame:
    return i.once("response_parts", lambda: first.result_parts(response_rows(i)))


def response_nodes(i: Inputs) -> DataFrame:
    return i.once("response_nodes", lambda: first.evidence_nodes(response_parts(i)))


def response_problems(i: Inputs) -> DataFrame:
    return i.once("response_problems", lambda: first.all_issues(response_rows(i), response_parts(i), response_nodes(i)))


def response_texts(i: Inputs) -> DataFrame:
    return i.once("response_texts", lambda: first.evidence_texts(response_nodes(i), response_days(i)))


def response_days(i: Inputs) -> DataFrame:
    return response_rows(i).select("observation_id", "collected_at")


def evidence_version(i: Inputs):
    """A version of the brand registry both engines can compute."""
    return brands(i).agg(F.md5(F.array_join(F.array_sort(F.collect_list("brand_id")), ","))).scalar()


def response_mentions(i: Inputs) -> DataFrame:
    return i.once("response_mentions", lambda: first.brand_evidence(
        response_nodes(i), response_texts(i), brands(i), i.bind("src_response_aliases"), domains(i), response_days(i), evidence_version(i)
    ))


def response_rules(i: Inputs) -> DataFrame:
    from sightline.sources.registries import approved_rules

    return approved_rules(i.bind("src_response_rules"))


def response_categories(i: Inputs) -> DataFrame:
    return i.once("response_categories", lambda: first.category_evidence(response_texts(i), response_rules(i)))


def response_summaries(i: Inputs) -> DataFrame:
    has_rules = response_rules(i).agg(F.count("*") > 0).scalar()
    return first.summaries(
        response_rows(i), response_parts(i), response_nodes(i), response_problems(i), response_mentions(i), response_categories(i), brands(i),
        has_rules, evidence_version(i),
    )


step("o_response_nodes", """
    select k, c, path, parent, top, serp, case kind when 'product' then 'product_card' when 'answer_text' then 'answer_block' when 'paid' then 'unsupported' when 'answer_module' then 'unsupported' else kind end as kind
    from o_nodes join (select k, serp, listed from o_tree) using (k)
    where listed and kind not in ('retained_nested', 'ad_link') and path not like '%.links[1]' and path not like '%.markdown' and not (serp and path like '%.items[3].items%')""")


@query("response_tree_counts", "select kind as item_kind, count(*) as nodes from o_response_nodes group by 1")
def _(i):
    return response_nodes(i).groupBy("item_kind").agg(F.count("*").alias("nodes"))


step("o_response_issues", f"""
    with t as (select *, {R} as b, case when serp then '.items[0]' else '.items[0]' end as ans, case when serp then '.items[2]' else '.items[1]' end as prod from o_tree where collection_status <> 'pending'),
    l as (select * from t where listed)
    select k, 'result[0]:items_unavailable' as issue from t where not listed
    union all select k, b || ':malformed_sources' from l where c % 4 = 1
    union all select k, b || '.items[1]:unsupported_item_type' from l where serp and c % 3 <> 0
    union all select k, b || '.items[1].extra:unsupported_nested_content' from l where serp and c % 3 <> 0
    union all select k, b || '.items[1].links:unsupported_nested_content' from l where serp and c % 3 = 1
    union all select k, b || prod || ':product_items_unavailable' from l where c % 4 = 0
    union all select k, b || prod || '.items:unavailable' from l where c % 4 = 1
    union all select k, b || prod || '.items[1].spec:unsupported_nested_content' from l where c % 8 = 3
    union all select k, b || '.items[3]:unsupported_item_type' from l where serp or c % 11 = 5
    union all select k, b || '.items[3].items:unsupported_nested_content' from l where serp
    union all select k, b || '.items[0].sources:unavailable' from l where not serp and c % 8 = 1
    union all select k, b || '.items[2]:answer_content_unavailable' from l where not serp and c % 5 < 2
    union all select k, b || '.items[2]:unsupported_item_type' from l where not serp and c % 5 = 2""")
step("o_response_fields", """
    select *, 'title' as field, case when path like '%.items[0]' then 'Brand' || (c % 25) || ' gear' else 'x' end as txt from o_response_nodes where kind = 'organic'
    union all select *, 'description', 'buy' from o_response_nodes where kind = 'organic' and path like '%.items[0]'
    union all select *, 'title', case when path like '%.items[0]' then 'Brand' || (c % 25) || ' shoe' else 'y' end from o_response_nodes where kind = 'product_card'
    union all select *, 'brand', ' Acme' || (c % 9) || ' ' from o_response_nodes where kind = 'product_card' and path like '%.items[0]'
    union all select *, 'markdown', 'See Brand' || (c % 25) || ' and again or https://x.net/y now' from o_response_nodes where kind = 'answer_block' and path like '%.items[0]'
    union all select *, 'text', 'plain words' from o_response_nodes where kind = 'answer_block' and path like '%.items[2]' and c % 5 in (3, 4)""")
NO_WORD = r"[^\p{L}\p{N}_]"
WHOLE_WORD = rf"""contains(lower(f.txt), w.needle) and (strpos(lower(f.txt), w.needle) = 1 or regexp_matches(substr(f.txt, strpos(lower(f.txt), w.needle)::int - 1, 1), '{NO_WORD}'))
        and (strpos(lower(f.txt), w.needle) + length(w.needle) > length(f.txt) or regexp_matches(substr(f.txt, (strpos(lower(f.txt), w.needle) + length(w.needle))::int, 1), '{NO_WORD}'))"""
step("o_response_mentions", f"""
    with w as (select brand_id, canonical_name, lower(trim(canonical_name)) as needle, effective_start_date as s, effective_end_date as e, effective_start_date as s2, effective_end_date as e2 from o_ok_brands where canonical_name is not null
      union all select brand_id, b.canonical_name, lower(trim(alias_text)), a.effective_start_date, a.effective_end_date, b.effective_start_date, b.effective_end_date from src_response_aliases a join o_ok_brands b using (brand_id)
        where alias_text is not null and lower(alias_text) not like '%placeholder%'),
    m as (select distinct f.k, f.path, f.kind, w.brand_id, w.canonical_name, f.field, strpos(lower(f.txt), w.needle) - 1 as s, length(w.needle) as n, f.txt
      from o_response_fields f join o_tree t using (k) join w on {WHOLE_WORD}
        and (w.s is null or t.collected_at >= w.s) and (w.e is null or t.collected_at <= w.e) and (w.s2 is null or t.collected_at >= w.s2) and (w.e2 is null or t.collected_at <= w.e2)),
    u as (select k, c, path, kind, case when kind = 'organic' then 'm.brand' || (c % 30) || '.shop' when path like '%references[0]' then 'brand3.shop' when path like '%inline_links%' then 'brand' || (c % 30) || '.shop'
        when path like '%.result[0].sources[%' then 'brand4.shop' when path like '%.sources[0]' then 'brand1.shop' end as host from o_response_nodes where (kind = 'organic' and path like '%.items[0]') or kind = 'citation')
    select k, path, brand_id, canonical_name, case kind when 'organic' then 'serp_title_snippet' when 'product_card' then 'product_card' else 'answer_text' end as evidence_type, field as matched_field,
      substr(txt, s::int + 1, n::int) as matched_text, s::int as span_start, (s + n)::int as span_end from m
    union all select u.k, u.path, d.brand_id, b.canonical_name, case u.kind when 'citation' then 'citation' else 'owned_domain' end, 'url', u.host, null, null
      from u join o_tree t using (k) join o_domains d on u.host = lower(trim(d.domain)) or ends_with(u.host, '.' || lower(trim(d.domain))) join o_ok_brands b on b.brand_id = d.brand_id and {VALID}
      where not ends_with(d.domain, '.test')""")
step("o_response_categories", f"""
    select f.k, f.path, w.category_id, w.category_name, f.field as matched_field, w.term as matched_text, 'reviewed_explicit_term' as method, w.rule_id
    from o_response_fields f join (select *, lower(trim(term)) as needle from src_response_rules where review_status = 'approved' and lower(active) = 'true') w
      on w.matched_field = f.field and w.item_kind in ('*', f.kind) and {WHOLE_WORD}""")
EVIDENCE_ITEM_ID = duck_evidence_id("'obs' || k", "path", "'response-evidence-1'")


@query("response_brand_evidence", f"""
    select 'obs' || k as observation_id, {EVIDENCE_ITEM_ID} as item_id, brand_id, canonical_name as brand_name, evidence_type, matched_field, matched_text, span_start, span_end from o_response_mentions""")
def _(i):
    return response_mentions(i).select(
        "observation_id", "item_id", "brand_id", "brand_name", "evidence_type", "matched_field", "matched_text", "span_start", "span_end"
    )


@query("response_category_evidence", f"""
    select 'obs' || k as observation_id, {EVIDENCE_ITEM_ID} as item_id, category_id, category_name, matched_field, matched_text, method, rule_id, 't1' as taxonomy_version, 'r1' as rule_version from o_response_categories""")
def _(i):
    return response_categories(i).drop("evidence_id")


@query("response_items", f"""
    select {EVIDENCE_ITEM_ID} as item_id, 'obs' || k as observation_id, path as json_path, kind as item_kind,
      case when kind = 'unsupported' or exists (select 1 from o_response_issues x where x.k = n.k and (starts_with(x.issue, n.path || ':') or starts_with(x.issue, n.path || '.'))) then 'partial' else 'complete' end as coverage_status
    from o_response_nodes n""")
def _(i):
    return first.response_items(response_nodes(i), response_problems(i)).select("item_id", "observation_id", "json_path", "item_kind", "coverage_status")


step("o_response_summaries", """
    with iss as (select k, '[' || string_agg('"' || issue || '"', ', ' order by issue) || ']' as issues from o_response_issues group by 1),
    br as (select k, string_agg(brand_id, ',' order by brand_id) as ids, string_agg(canonical_name, ',' order by brand_id) as names, count(*) as n from (select distinct k, brand_id, canonical_name from o_response_mentions) group by 1),
    an as (select k, string_agg(distinct brand_id, ',' order by brand_id) as ids from o_response_mentions where evidence_type = 'answer_text' group by 1),
    ci as (select k, string_agg(distinct brand_id, ',' order by brand_id) as ids from o_response_mentions where evidence_type = 'citation' group by 1),
    ca as (select k, string_agg(distinct category_id, ',' order by category_id) as ids from o_response_categories group by 1),
    nd as (select k, count(*) as n, count(*) filter (kind = 'organic') as org, count(*) filter (kind = 'product_card') as card, count(*) filter (kind = 'answer_block') as ans, count(*) filter (kind = 'image') as img, count(*) filter (kind = 'citation') as cit from o_response_nodes group by 1),
    t as (select *, case when collection_status = 'pending' then 'pending' when iss.issues is null then 'complete' else 'partial' end as cov,
      exists (select 1 from o_ok_brands b where (b.effective_start_date is null or o.collected_at >= b.effective_start_date) and (b.effective_end_date is null or o.collected_at <= b.effective_end_date)) as approved,
      case when collection_status <> 'pending' and listed then case when serp then 4 else 3 + (c % 11 = 5)::int end end as top_n from o_tree o left join iss using (k))
    select t.*, cov = 'complete' as ok, br.ids as brand_ids, br.names as brand_names, br.n as brand_n, an.ids as answer_ids, ci.ids as cited_ids, ca.ids as categories, nd.n as atoms, org, card, ans, img, cit
    from t left join br using (k) left join an using (k) left join ci using (k) left join ca using (k) left join nd using (k)""")


@query("response_summaries", """
    select observation_id, source_category, request_id, response_id, raw_file_hash, query_id, provider, engine_or_platform, cast(collected_at as string) as collected_at, 'kw' as query_text, null as model_name, 'zh-cn' as language_code, '2840' as location_code,
      collection_status, 't' as task_id, 20000 as status_code, cov as evidence_coverage_status, case when not ok then cov when approved then 'complete' else 'no_approved_registry' end as brand_coverage_status,
      case when not ok then cov else 'reviewed_rules' end as category_coverage_status, case when top_n is not null then 4 end as provider_reported_item_count, top_n as top_level_item_count,
      case when ok then coalesce(atoms, 0) end as atomic_item_count, case when ok then org end as organic_count, case when ok then card end as product_card_count, case when ok then ans end as answer_block_count, case when ok then img end as image_count, case when ok then cit end as citation_count,
      case when ok and approved then coalesce(brand_n, 0) end as distinct_brand_count, coalesce(brand_ids, '') as brand_ids, coalesce(brand_names, '') as brand_names, coalesce(answer_ids, '') as answer_brand_ids, coalesce(cited_ids, '') as cited_brand_ids,
      case when top_n is null then '' when serp then case when c % 3 = 0 then 'ai_overview,organic,shopping' else 'ai_overview,organic,paid,shopping' end
        else array_to_string(list_sort(list_distinct(['chat_gpt_text', 'gemini_products', case c % 5 when 0 then 'gemini_table' when 2 then 'widget' else 'gemini_text' end, case when c % 11 = 5 then 'unknown' else 'chat_gpt_text' end])), ',') end as result_types,
      coalesce(categories, 'unknown') as business_categories, coalesce(issues, '[]') as issues_json, 'response-evidence-1' as enrichment_version,
      (select md5(string_agg(brand_id, ',' order by brand_id)) from o_brands) as registry_version
    from o_response_summaries""")
def _(i):
    return response_summaries(i)


@query("summary_invariants", """
    select 'response_counts' as rule, observation_id as failure_id from o_response_summaries where c % 25 = 3 and (not ok or approved)""")
def _(i):
    """Every 25th summary is damaged: counts where none may be, or a negative one."""
    hit = i.bind("src_tree_payloads").filter("c % 25 = 3").select("observation_id", F.lit(True).alias("_hit"))
    rows = response_summaries(i).join(growing(hit), "observation_id", "left")
    wrong = F.when(F.col("evidence_coverage_status") == "complete", F.when(F.col("brand_coverage_status") == "complete", -1)).otherwise(1)
    damaged = rows.withColumn("organic_count", F.when(F.col("_hit") & wrong.isNotNull(), wrong.cast("bigint")).otherwise(F.col("organic_count")))
    return quality.summary_invariants(damaged.drop("_hit"))


@query("coverage_invariants", "select 'feature_coverage' as rule, feature || observation_id as failure_id from o_coverage where coverage_status = 'partial' and c % 5 = 0")
def _(i):
    wrong = (F.col("coverage_status") == "partial") & (F.substring_index("observation_id", "obs", -1).cast("bigint") >= 0)
    hits = i.bind("src_tree_payloads").filter("c % 5 = 0").select("observation_id", F.lit(True).alias("_hit"))
    rows = coverage(i).join(growing(hits), "observation_id", "left").withColumn("feature_id", F.concat("feature", "observation_id"))
    damaged = rows.withColumn("exhaustive_count", F.when(wrong & F.col("_hit"), F.lit(1)).otherwise(F.col("exhaustive_count")))
    items_ = tree_items(i)
    return quality.coverage_invariants(damaged, items_, evidence.result_context(results(i), items_, issues(i)))


@query("candidate_review_queue", """
    select 'obs' || k as observation_id, path as json_path, 'Acme' || (c % 9) as identity_name, '' as reviewer, '' as decision from o_nodes where kind = 'product' and path like '%.items[0]'""")
def _(i):
    from sightline.operators.review_queue import candidate_queue

    items_ = tree_items(i)
    context = evidence.result_context(results(i), items_, issues(i))
    return candidate_queue(matches(i), items_, context).select("observation_id", "json_path", "identity_name", "reviewer", "decision")


# --- extraction benchmark -------------------------------------------------------------------------


@query("extraction_benchmark", """
    with p as (select doc_id, lang from documents where n_chars > 500), l as (select doc_id, lang from labels join documents using (doc_id) where quality = 1),
    j as (select coalesce(p.lang, l.lang) as lang, p.doc_id as p, l.doc_id as l from p full outer join l on p.doc_id = l.doc_id)
    select lang, count(*) filter (p is not null and l is not null) as true_positives, count(*) filter (p is not null and l is null) as false_positives, count(*) filter (p is null and l is not null) as false_negatives,
      case when count(p) > 0 then (count(*) filter (p is not null and l is not null))::double / count(p)::double end as precision, case when count(l) > 0 then (count(*) filter (p is not null and l is not null))::double / count(l)::double end as recall from j group by 1""")
def _(i):
    docs = i.table("documents")
    said = docs.filter("n_chars > 500").select("doc_id", "lang")
    true = i.table("labels").filter("quality = 1").join(docs.select("doc_id", "lang"), "doc_id").select("doc_id", "lang")
    return quality.extraction_benchmark(said, true, ["doc_id", "lang"], ["lang"])
