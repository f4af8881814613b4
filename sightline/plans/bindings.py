"""Domain inputs derived from the given tables.

Every binding is a plain projection written in SQL that Spark and the checking engine both accept,
so operators see realistic search observations, answers, registries, payloads and event logs whose
size grows with the tables. ``resolve`` finds the bindings a text refers to, in dependency order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.session import stored

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

BINDINGS: dict[str, str] = {
    # --- observations -------------------------------------------------------------------------
    "src_search": """
        select cast(o_orderkey as string) as observation_id,
          'q' || cast(o_custkey % 20 as string) as query_id,
          case when o_custkey % 2 = 0 then ' northwind ' else 'contoso' end as provider,
          lower(substr(o_orderpriority, 3)) as search_engine,
          'organic' as search_type,
          case o_custkey % 7 when 0 then null when 1 then ' ' when 2 then ' 2840 ' else '2156' end as location_code,
          case o_custkey % 5 when 0 then 'EN' when 1 then ' zh_CN ' when 2 then 'zh-cn' when 3 then null else 'en' end as language_code,
          case o_custkey % 3 when 0 then 'desktop' when 1 then 'mobile' else null end as device,
          case when o_custkey % 11 = 0 then null else 'w' || cast(o_custkey % 4 as string) end as collection_window,
          'r' || cast(o_orderkey as string) as response_id,
          'run' || cast(o_custkey % 10 as string) as source_ingestion_id,
          md5(cast(o_orderkey as string)) as raw_file_hash,
          o_orderstatus = 'F' as has_results,
          case o_orderstatus when 'F' then 'available'
            when 'O' then case when o_custkey % 3 = 0 then 'available' else 'no_results' end
            else case when o_custkey % 13 = 0 then null else 'provider_error' end end as outcome_status
        from orders""",
    "src_organic": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' ||
            cast(l_partkey as string) || '-' || cast(l_suppkey as string) as organic_result_id,
          cast(l_orderkey as string) || '/' || cast(l_linenumber as string) || '/' ||
            cast(l_partkey as string) || '/' || cast(l_suppkey as string) as parent_serp_item_id,
          cast(l_orderkey as string) as observation_id, 'northwind' as provider, 'urgent' as search_engine,
          'organic' as search_type, true as feature_supported, true as feature_observed,
          l_linenumber as engine_rank, l_linenumber as normalized_rank,
          'https://brand' || cast(l_partkey % 30 as string) || '.shop/' as raw_url,
          'https://brand' || cast(l_partkey % 30 as string) || '.shop/' as canonical_url,
          ' title ' || cast(l_suppkey as string) || ' ' as title, '' as description
        from lineitem where l_returnflag <> 'R'""",
    "src_items": """
        select cast(l_orderkey as string) || '/' || cast(l_linenumber as string) || '/' ||
            cast(l_partkey as string) || '/' || cast(l_suppkey as string) as serp_item_id,
          cast(l_orderkey as string) as observation_id, 'urgent' as engine, l_linenumber as item_index,
          case when l_returnflag = 'R' then 'featured_snippet' else 'organic' end as raw_item_type,
          case when l_returnflag = 'R' then 'featured_snippet' else 'organic' end as normalized_item_type,
          l_linenumber as rank_group, l_linenumber as rank_absolute, cast(null as int) as page,
          l_linenumber as position,
          case when l_suppkey % 9 = 0 then null else 'Brand' || cast(l_partkey % 30 as string) || '.Shop' end as raw_domain,
          case when l_suppkey % 9 = 0 then null else 'Brand' || cast(l_partkey % 30 as string) || '.Shop' end as normalized_domain,
          'https://brand' || cast(l_partkey % 30 as string) || '.shop/' as raw_url,
          'https://brand' || cast(l_partkey % 30 as string) || '.shop/' as canonical_url,
          'title' as title, '' as description, '{}' as raw_item_json,
          'normalized' as normalization_status, cast(null as string) as parsing_warning
        from lineitem""",
    "src_quarantine": """
        select md5(cast(l_orderkey as string) || '|' || cast(l_linenumber as string) || '|' || cast(l_partkey as string)) as quarantine_id,
          cast(l_orderkey as string) as observation_id, 'urgent' as engine, l_linenumber as item_index,
          case when l_quantity > 45 then 'invalid_rank' else ' unknown_item_type ' end as reason, '{}' as raw_item_json
        from lineitem where l_quantity > 40""",
    "src_answers": """
        select 'a' || cast(doc_id as string) as observation_id, 'q' || cast(doc_id as string) as request_id,
          'rd' || cast(doc_id as string) as response_id, 'northwind' as provider, source as platform,
          case when doc_id % 3 = 0 then 'm1' else ' m2 ' end as model_name,
          'question ' || cast(doc_id % 20 as string) as query_text, 't' || cast(doc_id as string) as task_id,
          20000 as status_code, cast(0.5 as double) as cost,
          case when doc_id % 9 = 0 then 'zh_CN' when doc_id % 9 = 1 then null else lang end as language_code,
          case doc_id % 4 when 0 then '2840' when 1 then null else '2156' end as location_code,
          cast(doc_id % 4 as int) as items_count, text as response_text,
          '[{"index":0,"json_path":"$.brand3.shop","raw_item":{"x":"and onesen"},"text":"' ||
            lower(p.w) || ' brand' || cast(doc_id % 40 as string) || '"},{"index":1,"text":null}]' as items_json,
          case when doc_id % 6 = 0 then 'not json' else
            '[{"domain":"brand' || cast(doc_id % 30 as string) || '.shop"},{"domain":"other.net"}]' end as citations_json,
          md5(cast(doc_id as string)) as raw_file_hash,
          case doc_id % 5 when 0 then 'no_results' when 1 then 'quarantined' when 2 then case when doc_id % 7 = 0 then null else 'available' end else 'available' end as outcome_status
        from (select *, split_part(translate(text, '"' || chr(92) || chr(10), '   '), ' ', 3) as w from documents) p""",
    "src_requests": """
        select 'q' || cast(doc_id as string) as request_id, 'run' || cast(doc_id % 10 as string) as run_id,
          'llm' as source_category, 'northwind' as provider, source as platform, cast(null as string) as search_engine,
          'm1' as model_name, case doc_id % 4 when 0 then 'completed' when 1 then 'partial_success' when 2 then ' failed ' else null end as request_status,
          cast(doc_id % 100 as double) / 100 as estimated_cost, 'p' || cast(doc_id % 20 as string) as query_id,
          's' || cast(doc_id % 6 as string) as search_target_id,
          case when doc_id % 11 = 0 then ' ' else 'w' || cast(doc_id % 4 as string) end as collection_window,
          md5('h' || cast(doc_id as string)) as request_hash, md5('d' || cast(doc_id % 500 as string)) as deduplication_key
        from documents
        union all
        select 'o' || cast(o_orderkey as string), 'run' || cast(o_custkey % 10 as string), 'serp',
          case when o_custkey % 2 = 0 then 'northwind' else 'contoso' end, cast(null as string),
          case o_custkey % 4 when 0 then 'Google' when 1 then 'bing' when 2 then 'yahoo' else 'other' end, cast(null as string),
          case o_orderstatus when 'F' then 'completed' when 'O' then 'submitted_pending_result' else 'failed' end,
          cast(o_custkey % 100 as double) / 100, 'q' || cast(o_custkey % 20 as string), 's' || cast(o_custkey % 6 as string),
          'w' || cast(o_custkey % 4 as string), case when o_custkey % 10 = 0 then null else md5('h' || cast(o_custkey as string)) end,
          md5('d' || cast(o_custkey % 700 as string))
        from orders""",
    "src_responses": """
        select 'r' || cast(o_orderkey as string) as response_id, 'o' || cast(o_orderkey as string) as request_id,
          'pr' || cast(o_orderkey as string) as provider_request_id,
          case when o_custkey % 17 = 0 then null else o_orderstatus <> 'P' end as response_valid,
          case when o_custkey % 8 = 0 then cast(0 as double) else cast(o_custkey % 100 as double) / 100 end as actual_cost,
          case when o_custkey % 12 = 0 then null else cast(o_orderdate as date) end as received_at,
          case when o_custkey % 9 = 0 then ' ' when o_custkey % 9 = 1 then null else 't' || cast(o_orderkey as string) end as task_id
        from orders
        union all
        select 'rd' || cast(doc_id as string), 'q' || cast(doc_id as string), 'pd' || cast(doc_id as string),
          case when doc_id % 17 = 0 then null else doc_id % 5 <> 1 end, cast(doc_id % 50 as double) / 100,
          case when doc_id % 12 = 0 then null else date '1998-01-01' + cast(doc_id % 900 as int) end, 't' || cast(doc_id as string)
        from documents""",
    # --- registries ---------------------------------------------------------------------------
    "src_brand_numbers": "select distinct cast(replace(p_brand, 'Brand#', '') as int) as n from part",
    "src_brands": """
        select 'brand' || cast(n as string) as brand_id,
          case when n = 7 then 'Example Goods' when n % 6 = 5 then null else ' Brand' || cast(n as string) || ' ' end as canonical_name,
          case n % 4 when 0 then 'owned' when 1 then 'competitor' when 2 then 'Competitor' else 'partner' end as ownership_type,
          case when n % 2 = 0 then 'US' else 'CN' end as market, case when n % 2 = 0 then 'en' else 'zh' end as language,
          case when n % 3 = 0 then null when n % 3 = 1 then date '1996-06-01' else date '1998-01-01' end as effective_start_date,
          case when n % 5 = 0 then date '2000-06-30' else null end as effective_end_date, n % 9 <> 8 as active
        from src_brand_numbers""",
    "src_aliases": """
        select 'al' || cast(item_id as string) as brand_alias_id, 'brand' || cast(item_id % 27 as string) as brand_id,
          case item_id % 3 when 0 then split_part(text, ' ', 1) when 1 then split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3)
            else ' ' || split_part(text, ' ', 4) || ' ' end as alias_text,
          'US' as market, 'en' as language,
          case when item_id % 4 = 0 then date '1997-01-01' else null end as effective_start_date, cast(null as date) as effective_end_date
        from benchmark""",
    "src_domains": """
        select 'dm' || cast(n as string) as brand_domain_id, 'brand' || cast(n as string) as brand_id,
          case when n % 6 = 0 then ' BRAND' || cast(n as string) || '.SHOP ' when n = 10 then 'brand10.test' else 'brand' || cast(n as string) || '.shop' end as domain,
          'US' as market, 'en' as language, cast(null as date) as effective_start_date, cast(null as date) as effective_end_date
        from src_brand_numbers""",
    "src_comparisons": """
        select 'c' || cast(n_nationkey as string) as comparison_id, 'q' || cast(n_nationkey % 22 as string) as query_id,
          'p' || cast((n_nationkey * 7) % 23 as string) as prompt_id, n_nationkey % 6 <> 5 as active,
          'v' || cast(n_regionkey as string) as mapping_version,
          case when n_nationkey % 8 = 7 then ' ' else 'reviewer' end as reviewer, 'approved' as reason,
          date '1997-01-01' as effective_start_date,
          case when n_nationkey % 10 = 9 then date '1996-01-01' else null end as effective_end_date,
          case when n_nationkey % 12 = 11 then 'other' else 'matched_locale_window' end as scope
        from nation""",
    "src_queries": """
        select 'q' || cast(p_partkey as string) as query_id, p_name as keyword,
          case when p_partkey % 2 = 0 then 'en' else 'ZH' end as language, 'US' as market, p_size % 5 <> 0 as active
        from part""",
    "src_prompts": """
        select 'p' || cast(p_partkey as string) as prompt_id, p_type as prompt_text, p_type as prompt_group,
          case when p_partkey % 3 = 0 then 'zh' else 'En' end as language, 'US' as market, p_size % 7 <> 0 as active
        from part""",
    "src_search_targets": """
        select 's' || cast(s_suppkey as string) as search_target_id, case when s_suppkey % 10 = 0 then 'Bing' else 'northwind' end as provider,
          case s_suppkey % 3 when 0 then 'google' when 1 then 'bing' else 'yahoo' end as search_engine, 'organic' as search_type,
          case when s_suppkey % 7 = 0 then 'batch' else 'standard' end as retrieval_method,
          case when s_suppkey % 11 = 0 then 'bad code!' else cast(2000 + s_nationkey as string) end as location_code,
          case when s_suppkey % 13 = 0 then 'e' else 'en-US' end as language_code, 'desktop' as device, 'windows' as operating_system,
          cast(s_suppkey % 6 as int) as depth, s_nationkey % 4 <> 0 as active
        from supplier""",
    "src_answer_targets": """
        select 'lt' || cast(s_suppkey as string) as llm_target_id, 'northwind' as provider,
          case when s_suppkey % 9 = 0 then 'Northwind' when s_suppkey % 2 = 0 then 'chat_gpt' else 'gemini' end as platform,
          case s_suppkey % 4 when 0 then 'TO_BE_VERIFIED' when 1 then 'chat_gpt' when 2 then 'gemini' else 'mystery' end as model_name,
          'scrape' as endpoint_name, cast(2000 + s_nationkey as string) as location_code, 'en' as language_code, s_nationkey % 4 <> 1 as active
        from supplier""",
    "src_assignments": """
        select 'as' || cast(o_orderkey as string) as assignment_id, 'q' || cast(o_custkey % 40 as string) as query_id,
          's' || cast(o_orderkey % 130 as string) as search_target_id, o_orderstatus <> 'P' as active
        from orders""",
    "src_prompt_assignments": """
        select 'pa' || cast(c_custkey as string) as assignment_id, 'p' || cast(c_custkey % 60 as string) as prompt_id,
          'lt' || cast(c_custkey % 110 as string) as llm_target_id, c_acctbal > 0 as active
        from customer""",
    "src_rules": """
        select 'rule' || cast(item_id as string) as rule_id, 'cat' || cast(item_id % 6 as string) as category_id,
          'Category ' || cast(item_id % 6 as string) as category_name,
          split_part(text, ' ', cast(5 + item_id % 3 as int)) as term,
          case item_id % 4 when 0 then 'text' when 1 then 'title' when 2 then 'markdown' else 'merchant' end as matched_field,
          case item_id % 3 when 0 then '*' when 1 then 'answer_block' else 'organic' end as item_kind,
          't1' as taxonomy_version, case when item_id % 10 = 9 then '' else 'r1' end as rule_version,
          case when item_id % 5 = 4 then 'candidate' else 'approved' end as review_status,
          case when item_id % 7 = 6 then 'False' else 'TRUE' end as active
        from benchmark""",
    # First-generation registries: words that stand in the evidence trees.
    "src_response_aliases": """
        select 'ra' || cast(n as string) as brand_alias_id, 'brand' || cast(n as string) as brand_id,
          case n % 8 when 0 then 'gear' when 1 then ' SHOE ' when 2 then 'plain' when 3 then 'now' when 4 then 'plain'
            when 5 then 'placeholder' when 6 then 'again' else null end as alias_text,
          'US' as market, 'en' as language, case when n % 3 = 1 then date '1996-01-01' else null end as effective_start_date,
          case when n % 4 = 3 then date '1997-06-30' else null end as effective_end_date
        from src_brand_numbers""",
    "src_response_rules": """
        select 'rr' || cast(n as string) as rule_id, 'cat' || cast(n % 4 as string) as category_id, 'Category ' || cast(n % 4 as string) as category_name,
          case n % 6 when 0 then 'Gear' when 1 then 'shoe' when 2 then 'plain words' when 3 then ' again ' when 4 then 'acme' || cast(n % 9 as string) else 'buy' end as term,
          case n % 6 when 0 then 'title' when 1 then 'title' when 2 then 'text' when 3 then 'markdown' when 4 then 'brand' else 'title' end as matched_field,
          case when n % 5 = 0 then '*' when n % 6 = 0 then 'organic' when n % 6 in (1, 4) then 'product_card' when n % 6 in (2, 3) then 'answer_block' else 'organic' end as item_kind,
          't1' as taxonomy_version, 'r1' as rule_version, case when n % 11 = 10 then 'candidate' else 'approved' end as review_status,
          case when n % 13 = 12 then 'false' else 'TRUE' end as active
        from src_brand_numbers""",
    # --- event logs ---------------------------------------------------------------------------
    "src_reviews": """
        select 'opp' || cast(event_id - event_id % 6 as string) as opportunity_id, cast(event_id % 6 + case when event_id % 601 = 5 then 2 else 1 end as int) as sequence,
          'rel' || cast(case when event_id % 97 = 3 then 1 else 0 end as string) as release_id,
          case event_id % 6 when 0 then case when user_id % 20 = 0 then 'closed' else 'new' end
            when 1 then 'in_review' when 2 then case event_type when 'error' then 'needs_evidence' when 'view' then 'closed' else 'action_planned' end
            when 3 then case event_type when 'view' then 'in_review' when 'click' then 'archived' else 'action_planned' end
            when 4 then case event_type when 'signup' then 'experiment_running' else 'in_review' end
            else case event_type when 'error' then 'lost' else 'archived' end end as status,
          case user_id % 4 when 0 then 'observation' when 1 then 'hypothesis' when 2 then 'interpretation' else 'guess' end as classification,
          case when user_id % 30 = 0 then ' ' else 'u' || cast(user_id as string) end as reviewer, event_type as reason,
          case when user_id % 3 = 0 then '' else 'next' end as next_action,
          '["m' || cast(event_id % 500 as string) || '","e' || cast(user_id as string) || '"]' as evidence_json
        from events""",
    "src_attempts": """
        select 'att' || cast(event_id - event_id % 4 as string) as attempt_id, cast(event_id % 4 + 1 as int) as sequence,
          'run' || cast(user_id % 12 as string) as run_id, event_id as position, 't' || cast(user_id as string) as target_id,
          case when user_id % 2 = 0 then 'google' else 'bing' end as engine, cast(ts as date) as day,
          case event_id % 4 when 0 then 'planned' when 1 then case event_type when 'error' then 'sent' else 'sending' end
            when 2 then case event_type when 'click' then 'failed' else 'sent' end
            else case event_type when 'error' then 'failed' when 'view' then 'outcome_unknown' else 'success' end end as status,
          cast(round(value * 100) as bigint) as cents,
          case event_type when 'error' then 500 when 'click' then 429 when 'view' then 401 when 'signup' then 503 else 200 end as http_status,
          event_type
        from events""",
    # --- payloads -----------------------------------------------------------------------------
    "src_page_parts": """
        select o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as collected_at,
          case o_orderkey % 6 when 0 then 'retrieval' when 1 then 'live_advanced' when 2 then 'get' when 3 then 'post' when 4 then 'direct' else 'none' end as shape,
          case o_custkey % 8 when 0 then 'error' when 1 then 'pending' when 2 then 'nothing' when 3 then 'empty' when 4 then 'broken' else 'items' end as state,
          '{"description":"snippet","domain":"' || case when o_custkey % 3 = 0 then '' else 'Brand' || cast(o_custkey % 30 as string) || '.Shop.' end ||
            '","rank_absolute":' || cast(o_orderkey % 3 as string) || ',"rank_group":1,"title":"Page ' || cast(o_orderkey as string) ||
            '","type":"organic","url":"HTTPS://WWW.Brand' || cast(o_custkey % 30 as string) || '.Shop:443/p?x=' || cast(o_orderkey as string) || '#f"}' as item0,
          case o_orderkey % 5
            when 0 then '{"rank_absolute":2,"rank_group":2,"type":"featured_snippet","url":"http://a_b.example/x y"}'
            when 1 then '{"rank_absolute":2,"rank_group":2,"type":"mystery","url":"ftp://h/x"}'
            when 2 then '5'
            when 3 then '{"rank_group":2}'
            else '{"domain":"","rank_absolute":true,"rank_group":"2","type":"organic","url":""}' end as item1
        from orders""",
    "src_page_payloads": """
        select k, c, collected_at, shape, state, item0, item1,
          case shape when 'none' then '{"foo":1}' when 'direct' then body else '{"' || shape || '":' || body || '}' end as payload_text
        from (select *, '{"status_code":20000,"tasks":[{"data":{"device":"' || case when c % 4 = 0 then ' ' else 'mobile' end || '","location_code":' ||
            case when c % 5 = 0 then 'null' else cast(2000 + c % 5 as string) end || ',"se_type":true},"id":"t' || cast(k as string) || '","result":' ||
            case state when 'nothing' then 'null' when 'empty' then '[]' when 'broken' then '"oops"'
              else '[{"items":[' || item0 || ',' || item1 || ']},{"items":null}]' end ||
            ',"status_code":' || case state when 'error' then '40501' when 'pending' then '20100' else '20000' end || '}]}' as body
          from src_page_parts) b""",
    "src_tree_parts": """
        select o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as collected_at,
          case when o_custkey % 10 = 0 then 'pending' when o_custkey % 10 = 1 then 'no_results' else 'available' end as collection_status,
          case when o_orderkey % 2 = 0 then 'serp' else 'llm' end as source_category,
          '{"type":"organic","rank_group":' || cast(1 + o_custkey % 4 as string) || ',"rank_absolute":' || cast(1 + o_custkey % 4 as string) ||
            ',"title":"Brand' || cast(o_custkey % 25 as string) || ' gear","description":"buy","url":"https://m.brand' || cast(o_custkey % 30 as string) || '.shop/a"' ||
            case when o_custkey % 6 = 0 then ',"images":[{"url":"i1"},7]' else '' end || '}' as organic,
          case when o_custkey % 3 = 0 then '{"type":"organic","rank_group":null,"title":"x"}'
            else '{"type":"paid","title":"Ad","url":"https://brand' || cast(o_custkey % 30 as string) || '.shop","extra":{"ad_aclk":"z"},"links":' ||
              case when o_custkey % 3 = 1 then '[{"title":"L","url":"https://brand2.shop/l"},3]' else '"bad"' end || '}' end as paid,
          '{"type":"' || case when o_orderkey % 2 = 0 then 'shopping' else 'gemini_products' end || '"' ||
            case o_custkey % 4 when 0 then '' when 1 then ',"items":null'
              else ',"items":[{"title":"Brand' || cast(o_custkey % 25 as string) || ' shoe","brand":" Acme' || cast(o_custkey % 9 as string) || ' ","price":{"v":1}},{"title":"y"' || case when o_custkey % 8 = 3 then ',"spec":{"deep":{"z":[1]}}' else '' end || '}]' end || '}' as product,
          '{"type":"chat_gpt_text","markdown":"See [Brand' || cast(o_custkey % 25 as string) || '](https://brand' || cast(o_custkey % 30 as string) ||
            '.shop/q?a=1#z) and [again](https://brand' || cast(o_custkey % 30 as string) || '.shop/q?a=1) or https://x.net/y now"' ||
            case o_custkey % 8 when 0 then ',"sources":[{"url":"https://Brand1.Shop:443"},{"url":"mailto:x"}]' when 1 then ',"sources":null' else ',"sources":[{"url":"https://Brand1.Shop:443"}]' end || '}' as answer,
          case when o_custkey % 5 = 0 then '{"type":"gemini_table","table":[["a",1],["b",null]],"references":[]}'
            when o_custkey % 5 = 1 then '{"type":"gemini_text","text":""}' when o_custkey % 5 = 2 then '{"type":"widget"}'
            else '{"type":"gemini_text","text":"plain words","sources":[]}' end as extra
        from orders""",
    "src_tree_payloads": """
        select k, c, collected_at, collection_status, source_category,
          'obs' || cast(k as string) as observation_id, 'rq' || cast(k as string) as request_id, 'rs' || cast(k as string) as response_id,
          md5(cast(k as string)) as raw_file_hash, 'northwind' as provider, 'google' as engine_or_platform, 'q' || cast(c % 20 as string) as query_id,
          'asked' as query_text, 'en' as language_code, '2840' as location_code, cast(null as string) as model_name,
          '{"retrieval":{"tasks":[{"id":"t","data":{"depth":10,"keyword":"kw","language_code":"zh_CN"},"status_code":20000,"result":[{' ||
            case when c % 7 = 0 then '"items":"none"' when source_category = 'serp' then '"items":[' || organic || ',' || paid || ',' || product || ',{"type":"ai_overview","items":[' || answer || case when c % 9 = 0 then ',5' else '' end || '],"references":[{"url":"https://brand3.shop/r"}]}]'
              else '"items":[' || answer || ',' || product || ',' || extra || case when c % 11 = 5 then ',9' else '' end || ']' end ||
            case when c % 4 = 0 then ',"sources":[{"url":"https://brand4.shop/s"},{"url":"https://brand4.shop/s#t"}]' when c % 4 = 1 then ',"sources":{"a":1}' else '' end ||
            case when c % 14 = 0 then ',"markdown":"fallback Brand' || cast(c % 25 as string) || '"' else '' end ||
            ',"items_count":4,"language_code":' || case when c % 3 = 0 then 'null' else '"en_GB"' end || ',"location_code":2276}]}]}}' as payload_text
        from src_tree_parts""",
    "src_frozen_contexts": """
        select 'obs' || cast(k as string) as observation_id, md5(cast(k as string)) as raw_file_hash, 'w' || cast(k % 97 as string) as collection_window,
          'rs' || cast(k as string) as response_id, 'northwind' as provider, case when collection_status = 'pending' or c % 3 = 0 then 'zh-cn' else 'en-gb' end as language_code,
          case when collection_status = 'pending' then '2840' else '2276' end as location_code, 'q' || cast(c % 20 as string) as instrument_id,
          'google' as engine_or_platform, source_category, unnest([1, 2]) as brand_no
        from src_tree_parts""",
    "src_research_mappings": """
        select 'm' || cast(n_nationkey as string) as comparison_id, 'q' || cast(n_nationkey as string) as query_id, 'q' || cast((n_nationkey * 7) % 20 as string) as prompt_id,
          n_nationkey % 6 <> 5 as active, 'v' || cast(n_regionkey as string) as mapping_version, date '1997-01-01' as effective_start_date,
          case when n_nationkey % 10 = 9 then date '1996-01-01' else null end as effective_end_date
        from nation where n_nationkey < 20""",
    "src_answer_payloads": """
        select 'q' || cast(doc_id as string) as request_id, 'rd' || cast(doc_id as string) as response_id, md5(cast(doc_id as string)) as raw_file_hash,
          doc_id, lang, body_text, case doc_id % 10
            when 0 then '{"other":1}'
            when 1 then '{"retrieval":{"tasks":[]}}'
            when 2 then '{"retrieval":{"tasks":[{"result":[]}]}}'
            when 3 then '{"retrieval":{"tasks":[{},{}]}}'
            else '{"retrieval":{"cost":0.25,"status_code":20000,"tasks":[{"data":{"keyword":" kw' || cast(doc_id as string) || ' ","language_code":"' || lang ||
              '","location_code":2840,"se":"Chat_GPT"},"id":"t' || cast(doc_id as string) || '","result":[{"items":[{"markdown":"' || body_text ||
              '","rank_group":1,"sources":[{"domain":"d1.net","url":"https://d1.net/a"},7],"type":"gemini_text"},"skip",{"original_text":"  second part ","sources":null}]' ||
              case when doc_id % 10 = 4 then ',"markdown":"whole"' else '' end || '}]}]}}' end as payload_text
        from (select *, replace(replace(replace(text, chr(92), ''), '"', chr(92) || '"'), chr(10), chr(92) || 'n') as body_text from documents) d""",
    "src_raw_files": """
        select cast(o_orderkey as string) as k, o_orderkey as n, o_custkey as c, role_no,
          case when o_orderkey % 2 = 0 then 'serp' else 'llm' end || '/northwind/e' || cast(o_custkey % 3 as string) || '/' ||
            case when o_custkey % 2 = 0 then '2026/09/28' else '2026/10/02' end || '/run' || cast(o_custkey % 10 as string) || '/rq' || cast(o_orderkey as string) as directory,
          case role_no when 0 then 'request.json' when 1 then 'response.json' when 2 then 'metadata.json' else 'notes.json' end as file_name,
          '{"q":' || cast(o_orderkey as string) || '}' as request_text,
          case when o_custkey % 13 = 0 then '[1]' else '{"a":' || cast(o_orderkey as string) || ',"b":[1,2]}' end as response_text,
          case when o_custkey % 11 = 0 then '{"broken' when o_custkey % 5 = 0 then '{"b": [1, 2], "a": ' || cast(o_orderkey as string) || '}' else '{"note":1}' end as notes_text
        from (select *, unnest([0, 1, 2, 3]) as role_no from orders) o
        where not (o_custkey % 9 = 0 and role_no = 0) and not (o_custkey % 4 <> 0 and role_no = 3)""",
    "src_raw_content": """
        select path_no, directory, file_name, k, n, c, role_no, case role_no when 0 then request_text when 1 then response_text when 3 then notes_text
          else '{"source_category":"' || case when c % 17 = 0 then 'video' when n % 2 = 0 then 'serp' else 'llm' end || '","provider":"northwind","platform_or_engine":"e' || cast(c % 3 as string) ||
            '","run_id":"' || case when c % 19 = 0 then '' else 'run' || cast(c % 10 as string) end || '","request_id":"rq' || cast(n - n % 50 * case when c % 23 = 0 then 1 else 0 end as string) ||
            '","collected_at":"' || case c % 7 when 0 then '2026-09-28T10:00:00' when 1 then 'soon' else '2026-09-28T10:00:00+00:00' end ||
            '","files":{"request.json":{"sha256":"' || sha256(request_text) || '","byte_size":' || cast(length(request_text) as string) || ',"content_type":"application/json"},"response.json":{"sha256":"' ||
            case when c % 29 = 0 then 'bad' else sha256(response_text) end || '","byte_size":' || cast(length(response_text) + case when c % 31 = 0 then 1 else 0 end as string) ||
            case when c % 37 = 0 then '' else ',"content_type":"application/json"' end || '}}}' end as body
        from (select *, 0 as path_no from src_raw_files) f""",
}


def resolve(text: str, extra: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(name, sql) of the bindings a text needs, dependencies first."""
    known = {**BINDINGS, **(extra or {})}
    out: dict[str, str] = {}

    def add(body: str) -> None:
        for name in known:
            if name not in out and re.search(rf"\b{name}\b", body):
                add(known[name])
                out[name] = known[name]

    add(text)
    return list(out.items())


def for_spark(sql: str) -> str:
    """The two spellings that differ between the engines."""
    sql = re.sub(r"sha256\((\w+)\)", r"sha2(\1, 256)", sql)
    return re.sub(r"unnest\(\[(.*?)\]\)", r"explode(array(\1))", sql)


#: Payloads are built from narrow keys of one table; the keys are dealt out first, so that building and parsing uses all cores.
DEALT_KEYS = {"src_page_parts": ("orders", "o_orderkey"), "src_tree_parts": ("orders", "o_orderkey"), "src_raw_files": ("orders", "o_orderkey")}


class Inputs:
    """Given tables and bindings of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.shared: dict[str, DataFrame] = {}

    def once(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame several branches of one query use, written to the shared folder once."""
        if label not in self.shared:
            self.shared[label] = stored(build(), label)
        return self.shared[label]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def bind(self, name: str) -> DataFrame:
        chain = [*resolve(BINDINGS[name]), (name, BINDINGS[name])]
        text = " ".join(sql for _, sql in chain)
        dealt = dict(DEALT_KEYS[n] for n, _ in chain if n in DEALT_KEYS)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for table in TABLES:
            if re.search(rf"\b{table}\b", text):
                rows = self.table(table)
                rows = rows.repartition(parts, dealt[table]) if table in dealt else rows
                rows.createOrReplaceTempView(table)
        *needed, (_, body) = chain
        ctes = ", ".join(f"{n} as ({for_spark(q)})" for n, q in needed)
        return self.spark.sql((f"with {ctes} " if ctes else "") + for_spark(body))


def plain(df: DataFrame) -> DataFrame:
    """Comparable form: dates and timestamps as text, arrays joined, other types unchanged."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            columns.append(F.array_join(F.col(f.name), ",").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def oracle(body: str, steps: dict[str, str] | None = None) -> str:
    """Body with the bindings (and named steps) it uses as common table expressions."""
    parts = resolve(body, steps)
    if not parts:
        return body
    ctes = ",\n".join(f"{name} as materialized ({sql})" for name, sql in parts)
    stripped = body.strip()
    if stripped.lower().startswith("with "):
        return f"with {ctes},\n{stripped[5:]}"
    return f"with {ctes}\n{stripped}"
