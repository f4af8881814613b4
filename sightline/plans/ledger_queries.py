"""Raw evidence, registry, release, review and ledger queries over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import ids
from sightline.operators import ledger, publication, quality, release, reviews, shape
from sightline.plans.bindings import Inputs
from sightline.plans.catalog import query, step
from sightline.plans.visibility_queries import (
    HIT, answer_gold, brands, comparison_gold, comparisons, damaged, serp_gold,
)
from sightline.session import shared_dir
from sightline.sources import raw, registries, sinks, snapshots
from sightline.streaming import ingest

# ---------------------------------------------------------------------------
# Raw evidence files
# ---------------------------------------------------------------------------


def files(i: Inputs) -> DataFrame:
    rows = i.bind("src_raw_content")
    return raw.inventory(rows.select(
        F.concat_ws("/", F.lit("/root/raw"), "directory", "file_name").alias("path"),
        F.length(F.encode("body", "UTF-8")).cast("bigint").alias("length"), F.encode("body", "UTF-8").alias("content"),
    ))


step("o_files", """
    select *, directory || '/' || file_name as path, split_part(directory, '/', 1) as category, case role_no when 0 then 'request' when 1 then 'response' when 2 then 'metadata' else 'auxiliary' end as role,
      not (role_no = 3 and c % 11 = 0) as json_valid, length(body) as byte_size, sha256(body) as sha from src_raw_content""")
step("o_problems", """
    with d as (select distinct directory, n, c from o_files)
    select directory, n, c, list_sort(list_filter([
      case when c % 9 = 0 then 'missing request.json' end, case when c % 13 = 0 then 'non-object response.json' end,
      case when c % 29 = 0 then 'checksum mismatch for response.json' end, case when c % 31 = 0 then 'size mismatch for response.json' end, case when c % 37 = 0 then 'missing content_type for response.json' end,
      case when c % 19 = 0 then 'missing metadata run_id' end, case when c % 17 = 0 then 'source_category/path mismatch' end,
      case c % 7 when 0 then 'collected_at is not timezone aware' when 1 then 'invalid collected_at' end], lambda x: x is not null)) as problems from d""")
step("o_dispositions", """
    select f.path, f.role, p.problems, case when role = 'auxiliary' then case when not json_valid then 'quarantined_auxiliary' when c % 5 = 0 and c % 13 <> 0 then 'duplicate_response_representation' else 'auxiliary_not_result' end
      when len(p.problems) > 0 then 'quarantined_integrity' when role <> 'response' then role || '_evidence_not_result' else 'verified_response_candidate' end as disposition from o_files f join (select directory, problems from o_problems) p using (directory)""")


@query("raw_inventory", "select path, category, role, byte_size, sha as sha256, json_valid, case when not json_valid then null when role = 'response' and c % 13 = 0 then 'array' else 'object' end as json_type from o_files")
def _(i):
    return files(i).select("path", "category", "role", "byte_size", "sha256", "json_valid", "json_type")


@query("raw_inventory_of_day", "select path from o_files where directory like '%/2026/09/28/%'")
def _(i):
    return raw.on_day(files(i), "2026-09-28").select("path")


@query("triple_integrity", "select directory, array_to_string(problems, ',') as integrity_problems, len(problems) = 0 as triple_valid from o_problems")
def _(i):
    return raw.triple_integrity(files(i)).select("directory", "integrity_problems", "triple_valid")


@query("raw_dispositions", "select path, disposition from o_dispositions")
def _(i):
    return raw.dispositions(files(i)).select("path", "disposition")


STATUSES = ("available", "pending", "quarantined", "unsupported")
step("o_manifest_responses", """
    select *, case when n % 13 = 0 then null else list_value('available', 'pending', 'quarantined', 'unsupported')[n % 4 + 1] end as status, n % 3 = 0 and n % 5 <> 0 and not (c % 23 = 0 and n % 50 <> 0) as exact
    from o_dispositions d join (select path, n, c from o_files) using (path) where disposition = 'verified_response_candidate'""")


def manifest(i: Inputs) -> tuple[DataFrame, dict[str, int]]:
    """The written manifest of all raw files; every 13th response has no status, and older stores know some responses, a few of them changed."""
    number = F.regexp_extract("path", r"/rq(\d+)/", 1).cast("bigint")
    found = raw.dispositions(files(i)).withColumn("n", number)
    status = F.when((F.col("disposition") == raw.CANDIDATE) & (F.col("n") % 13 != 0), F.element_at(F.array(*map(F.lit, STATUSES)), (F.col("n") % 4 + 1).cast("int")))
    rows = found.withColumn("status", status)
    older = i.bind("src_raw_files").filter("role_no = 1 and n % 3 = 0").select(
        F.concat(F.lit("rq"), "k").alias("request_id"), F.when(F.col("n") % 5 == 0, "other").otherwise(F.sha2("response_text", 256)).alias("sha256"))
    return raw.write_accounted(raw.with_provenance(rows, older), f"{shared_dir(i.spark)}/sightline/manifest-{uuid.uuid4().hex}", STATUSES)


@query("raw_inventory_report", """
    select 'disposition' as section, disposition as name, count(*) as files, null::double as share from o_dispositions group by 2
    union all select 'problem', p, count(*), null from (select unnest(problems) as p from o_dispositions) group by 2
    union all select 'provenance', 'verified_responses', count(*), null from o_manifest_responses
    union all select 'provenance', 'exact_provenance', count(*) filter (exact), (count(*) filter (exact))::double / count(*)::double from o_manifest_responses""")
def _(i):
    rows, counts = manifest(i)
    report = raw.inventory_report(rows).withColumn("share", F.lit(None).cast("double"))
    return report.unionByName(raw.provenance_report(counts, i.spark))


@query("manifest_verification", """
    select directory, 'request.json' as file_name, case when c % 9 = 0 then 'missing_file' else 'verified' end as result from o_problems
    union all select directory, 'response.json', 'size_mismatch' from o_problems where c % 31 = 0
    union all select directory, 'response.json', 'checksum_mismatch' from o_problems where c % 29 = 0
    union all select directory, 'response.json', 'verified' from o_problems where c % 31 <> 0 and c % 29 <> 0""")
def _(i):
    return raw.verify_manifest(files(i))


@query("incomplete_directories", "select directory, false as has_request from o_problems where c % 9 = 0")
def _(i):
    return raw.incomplete_directories(files(i)).select("directory", "has_request")


@query("metadata_reconciliation", """
    select path, 'file_not_registered' as problem from o_files where n % 3 = 1 union all select path || '.gone', 'registered_file_missing' from o_files where n % 3 = 2
    union all select path, 'file_not_registered' from o_files where n % 3 = 2""")
def _(i):
    key = F.regexp_extract("path", r"/rq(\d+)/", 1).cast("bigint") % 3
    found = files(i).select("path", key.alias("m"))
    known = found.filter("m <> 1").select(F.when(F.col("m") == 2, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("relative_path"))
    return raw.reconcile_metadata(known, found)


@query("raw_registration", """
    with v as (select *, 'rq' || (n - n % 50 * case when c % 23 = 0 then 1 else 0 end) as request_id from o_problems),
    f as (select directory, request_id, row_number() over (partition by request_id order by directory) as rk from v where len(problems) = 0)
    select directory, request_id, 'register' as action from f where rk = 1 and request_id not in (select 'rq' || o_orderkey from orders where o_orderkey % 4 = 0)
    union all select directory, request_id, 'invalid' from v where len(problems) > 0""")
def _(i):
    known = i.table("orders").filter("o_orderkey % 4 = 0").select(F.concat(F.lit("rq"), F.col("o_orderkey").cast("string")).alias("request_id"))
    return raw.new_requests(raw.triple_integrity(files(i)), known)


@query("raw_accounting", """
    select 'files_without_disposition' as check_name, 0 as value union all select 'raw_files_changed', count(*) from o_files where role = 'response' and n % 10 = 0
    union all select 'responses_without_status', count(*) from o_manifest_responses where status is null""")
def _(i):
    rows, counts = manifest(i)
    moved = (F.col("role") == "response") & (F.col("n") % 10 == 0)
    after = rows.withColumn("sha256", F.when(moved, F.lit("changed")).otherwise(F.col("sha256")))
    return raw.accounting(counts, rows, after)


step("o_arrivals", "select user_id, event_id, ts, event_type, event_id % 4 as batch from events")


def arrivals(i: Inputs) -> list[DataFrame]:
    """Events in four micro-batches; later ones hold rows older than those of earlier ones."""
    rows = i.table("events").select("user_id", "event_id", "ts", "event_type")
    return [rows.filter(F.col("event_id") % 4 == b) for b in range(4)]


@query("upkept_latest_slices", """
    select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc nulls last, event_id) as rk from o_arrivals) where rk = 1""")
def _(i):
    target = f"{shared_dir(i.spark)}/sightline/slices-{uuid.uuid4().hex}"
    sink = ingest.latest_slice_sink(target, ["user_id"], "ts", "event_id", buckets=8)
    for number, batch in enumerate(arrivals(i)):
        sink(batch, number)
    return ingest.current_slices(i.spark, target, i.table("events").select("user_id", "event_id", "ts", "event_type").schema).select("user_id", "event_id", "event_type")


@query("batchwise_insert_or_ignore", """
    select user_id, event_id, batch from (select *, row_number() over (partition by user_id order by batch, event_id) as rk from o_arrivals) where rk = 1""")
def _(i):
    target = f"{shared_dir(i.spark)}/sightline/inserts-{uuid.uuid4().hex}"
    sink = ingest.insert_or_ignore_sink(target, ["user_id"], [F.asc("event_id")], buckets=8)
    for number, batch in enumerate(arrivals(i)):
        sink(batch, number)
    return i.spark.read.parquet(target).select("user_id", "event_id", F.col("batch").cast("bigint").alias("batch"))


@query("duplicate_requests", """
    with v as (select o_custkey, 'o' || o_orderkey as path, o_orderstatus as sha256, 'rq' || o_custkey as request_id from orders), w as (select *, count(*) over (partition by request_id) as n, min_by(sha256, path) over (partition by request_id) as fs, min(path) over (partition by request_id) as fp from v)
    select request_id, path, case when path = fp then 'accepted' when sha256 = fs then 'already_transformed' else 'request_id_collision' end as verdict from w where n > 1""")
def _(i):
    rows = i.table("orders").select(F.concat(F.lit("rq"), "o_custkey").alias("request_id"), F.concat(F.lit("o"), "o_orderkey").alias("path"), F.col("o_orderstatus").alias("sha256"))
    return raw.duplicate_requests(rows)


@query("provenance_context", """
    with s as (select 'rq' || o_custkey % 500 as request_id, o_orderstatus as sha256, 'db' || o_orderkey % 3 as source, 'q' || o_custkey % 500 % 7 as query_id, case when o_orderkey % 2 = 0 then '' else 'w' || o_custkey % 2 end as collection_window from orders),
    g as (select request_id, sha256, min(query_id) as q, min(nullif(collection_window, '')) as a, max(nullif(collection_window, '')) as b, count(distinct source) as sources from s group by 1, 2)
    select request_id, sha256, q as query_id, case when a = b then a end as collection_window, case when a <> b then 'collection_window' else '' end as conflicts, sources from g""")
def _(i):
    rows = i.table("orders").selectExpr(
        "concat('rq', o_custkey % 500) as request_id", "o_orderstatus as sha256", "concat('db', o_orderkey % 3) as source",
        "concat('q', o_custkey % 500 % 7) as query_id", "case when o_orderkey % 2 = 0 then '' else concat('w', o_custkey % 2) end as collection_window",
    )
    responses = rows.select("request_id", "sha256").distinct()
    return raw.reconcile_context(responses, rows, ("query_id", "collection_window"))


@query("transform_candidates", """
    select 'r' || o_orderkey as response_id, 'o' || o_orderkey as request_id, 'q' || o_custkey % 20 as query_id from orders where o_orderkey % 3 <> 0""")
def _(i):
    o = i.table("orders")
    key = F.col("o_orderkey").cast("string")
    artifacts = o.select(F.concat(F.lit("o"), key).alias("request_id"), F.lit("p").alias("relative_path"), F.lit("s").alias("sha256"), F.lit("response").alias("artifact_type"))
    done = o.filter("o_orderkey % 3 = 0").select(F.concat(F.lit("r"), key).alias("response_id"))
    found = raw.transform_candidates(artifacts, i.bind("src_requests"), i.bind("src_responses"), done, "serp")
    return found.select("response_id", "request_id", "query_id")


@query("insert_or_ignore", """
    with b as (select *, row_number() over (partition by o_custkey order by o_orderkey) as rk from orders where o_orderkey % 2 = 1)
    select o_orderkey, o_custkey from b where rk = 1 and o_custkey not in (select o_custkey from orders where o_orderkey % 10 = 0)""")
def _(i):
    o = i.table("orders").select("o_orderkey", "o_custkey")
    return shape.insert_or_ignore(o.filter("o_orderkey % 10 = 0"), o.filter("o_orderkey % 2 = 1"), ["o_custkey"], [F.asc("o_orderkey")])


@query("replace_by_key", """
    select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey not in (select l_orderkey from lineitem where l_quantity > 49)
    union all select l_orderkey, l_linenumber, 0.0 from lineitem where l_quantity > 49""")
def _(i):
    rows = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = rows.filter("l_quantity > 49").withColumn("l_quantity", F.lit(0.0))
    return shape.replace_by(rows, batch, ["l_orderkey"])


@query("ready_tasks_first", "select c_custkey, case when c_custkey in (select o_custkey from orders) then 1 else 0 end as ready from customer")
def _(i):
    ready = i.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    return shape.preferred_first(i.table("customer").select("c_custkey"), ready, "c_custkey")


@query("distinct_payload_rows", "select distinct event_type, user_id, props from events")
def _(i):
    return shape.distinct_rows(i.table("events").select("event_type", "user_id", "props")).drop("payload_json")


# ---------------------------------------------------------------------------
# Registries
# ---------------------------------------------------------------------------


@query("typed_registry_rows", """
    select 'b' || p_partkey as brand_id, cast(try_cast(case p_size % 5 when 0 then 'soon' when 1 then '' else '1999-0' || (1 + p_size % 9) || '-01' end as date) as string) as effective_start_date,
      case p_size % 3 when 0 then true when 1 then false end as active, array_to_string(list_filter([case when p_size % 5 < 2 then 'effective_start_date' end, case when p_size % 3 = 2 then 'active' end], lambda x: x is not null), ',') as problems from part""")
def _(i):
    text = i.table("part").selectExpr(
        "concat('b', p_partkey) as brand_id", "p_name as canonical_name", "'owned' as ownership_type", "'US' as market", "'en' as language",
        "case p_size % 5 when 0 then 'soon' when 1 then '' else concat('1999-0', 1 + p_size % 9, '-01') end as effective_start_date",
        "'' as effective_end_date", "case p_size % 3 when 0 then 'True' when 1 then 'FALSE' else 'yes' end as active",
    )
    return registries.coerce(registries.check_header(text, "brands"), "brands").select("brand_id", "effective_start_date", "active", "problems")


@query("category_rule_problems", """
    select rule_id, 'missing_or_placeholder_field' as problem from src_rules where review_status = 'approved' and lower(active) = 'true' and (rule_version = '' or term = '')
    union all select rule_id, 'field_not_classifiable' from src_rules where review_status = 'approved' and lower(active) = 'true' and matched_field = 'merchant'""")
def _(i):
    return registries.rule_problems(i.bind("src_rules"))


@query("registry_merge", """
    with st as (select 'b' || o_custkey as brand_id, o_orderstatus as name from orders), g as (select brand_id, min(name) as a, max(name) as b from st where brand_id not in (select 'b' || c_custkey from customer where c_custkey % 2 = 0) group by 1)
    select 'b' || c_custkey as brand_id, c_name as name, 'csv' as origin from customer where c_custkey % 2 = 0 union all select brand_id, case when a = b then a end, case when a = b then 'stored' else 'conflict' end from g""")
def _(i):
    csv = i.table("customer").filter("c_custkey % 2 = 0").selectExpr("concat('b', c_custkey) as brand_id", "c_name as name")
    stored = i.table("orders").selectExpr("concat('b', o_custkey) as brand_id", "o_orderstatus as name")
    return registries.merge_authoritative(csv, stored, "brand_id")


@query("assignment_dimension_counts", """
    with q as (select provider, search_engine, null as platform, cast(a.active as string) as active from src_assignments a join src_search_targets t on t.search_target_id = a.search_target_id), p as (select provider, null as se, platform, cast(a.active as string) as active from src_prompt_assignments a join src_answer_targets t on t.llm_target_id = a.llm_target_id),
    u as (select * from q union all select * from p)
    select 'provider' as dimension, provider as value, count(*) as assignments from u group by 2 union all select 'search_engine', search_engine, count(*) from u where search_engine is not null group by 2
    union all select 'platform', platform, count(*) from u where platform is not null group by 2 union all select 'active', active, count(*) from u group by 2""")
def _(i):
    none = F.lit(None).cast("string").alias("market")
    q = i.bind("src_assignments").join(i.bind("src_search_targets").select("search_target_id", "provider", "search_engine"), "search_target_id").select("assignment_id", "provider", "search_engine", none, "active")
    p = i.bind("src_prompt_assignments").join(i.bind("src_answer_targets").select("llm_target_id", "provider", "platform"), "llm_target_id").select("assignment_id", "provider", "platform", none, "active")
    return registries.dimension_counts(q, p)


@query("search_target_contracts", """
    select 'retrieval_method' as rule, search_target_id as failure_id from src_search_targets where retrieval_method = 'batch' union all select 'location_code', search_target_id from src_search_targets where location_code like 'bad%'
    union all select 'language_code', search_target_id from src_search_targets where language_code = 'e' union all select 'depth', search_target_id from src_search_targets where depth = 0
    union all select 'provider_differs', search_target_id from src_search_targets where lower(provider) = search_engine""")
def _(i):
    return quality.row_contracts(i.bind("src_search_targets"), "search_target_id", quality.search_target_rules())


@query("answer_target_contracts", """
    select 'model_name' as rule, llm_target_id as failure_id from src_answer_targets where model_name = 'mystery' union all select 'provider_differs', llm_target_id from src_answer_targets where lower(platform) = 'northwind'""")
def _(i):
    return quality.row_contracts(i.bind("src_answer_targets"), "llm_target_id", quality.answer_target_rules())


@query("comparison_contracts", """
    select 'reviewer' as rule, comparison_id as failure_id from src_comparisons where trim(reviewer) = '' union all select 'scope', comparison_id from src_comparisons where scope = 'other' union all select 'date_range', comparison_id from src_comparisons where effective_end_date < effective_start_date""")
def _(i):
    return quality.row_contracts(i.bind("src_comparisons"), "comparison_id", quality.comparison_rules())


@query("assignment_problems", """
    with r as (select a.*, q.active as qa, t.active as ta from src_assignments a left join src_queries q using (query_id) left join src_search_targets t using (search_target_id)),
    f as (select *, min(assignment_id) over (partition by query_id, search_target_id) as fst from r where active)
    select 'unknown_search_target_id' as rule, assignment_id as failure_id from r where ta is null union all select 'unknown_query_id', assignment_id from r where qa is null
    union all select 'duplicate_active_pair', assignment_id from f where assignment_id <> fst union all select 'inactive_source', assignment_id from r where active and qa is not null and ta is not null and not qa
    union all select 'inactive_target', assignment_id from r where active and qa is not null and ta is not null and not ta""")
def _(i):
    return quality.assignment_problems(i.bind("src_assignments"), i.bind("src_queries"), i.bind("src_search_targets"), "query_id", "search_target_id")


@query("comparison_problems", """
    with r as (select c.*, q.active as qa, p.active as pa, lower(q.language) as ql, lower(p.language) as pl from src_comparisons c left join src_queries q using (query_id) left join src_prompts p using (prompt_id)), a as (select * from r where active and qa is not null and pa is not null),
    f as (select *, min(comparison_id) over (partition by query_id, prompt_id) as fst from a)
    select 'unknown_instrument' as rule, comparison_id as failure_id from r where qa is null or pa is null union all select 'duplicate_active_pair', comparison_id from f where comparison_id <> fst
    union all select 'inactive_instrument', comparison_id from a where not (qa and pa) union all select 'language_differs', comparison_id from a where ql <> pl""")
def _(i):
    return quality.comparison_problems(i.bind("src_comparisons"), i.bind("src_queries"), i.bind("src_prompts"))


@query("overlapping_brand_windows", """
    with w as (select 's' || s_suppkey as brand_id, s_suppkey as n, s_nationkey, date '1996-01-01' + cast(s_suppkey * 37 % 2000 as int) as s, date '1996-01-01' + cast(s_suppkey * 37 % 2000 + 100 as int) as e from supplier)
    select a.brand_id from w a where exists (select 1 from w b where b.s_nationkey = a.s_nationkey and b.n <> a.n and b.s <= a.e and a.s <= b.e and (b.s < a.s or (b.s = a.s and b.brand_id < a.brand_id)))""")
def _(i):
    rows = i.table("supplier").selectExpr(
        "concat('s', s_suppkey) as brand_id", "concat('N', s_nationkey) as canonical_name", "'US' as market", "'en' as language",
        "date_add(date '1996-01-01', cast(s_suppkey * 37 % 2000 as int)) as effective_start_date", "date_add(date '1996-01-01', cast(s_suppkey * 37 % 2000 + 100 as int)) as effective_end_date",
    )
    return quality.overlapping_windows(rows).select("brand_id")


@query("resolved_assignments", """
    select assignment_id, keyword, search_engine from src_assignments a join src_queries q on q.query_id = a.query_id and q.active join src_search_targets t on t.search_target_id = a.search_target_id and t.active where a.active""")
def _(i):
    targets = i.bind("src_search_targets").select("search_target_id", "search_engine", "active")
    queries_ = i.bind("src_queries").select("query_id", "keyword", "active")
    return ledger.assignment_table(i.bind("src_assignments"), queries_, targets, "query_id", "search_target_id").select("assignment_id", "keyword", "search_engine")


# ---------------------------------------------------------------------------
# Releases
# ---------------------------------------------------------------------------


@query("release_assessment", f"""
    with s as (select 'serp' as ch, count(*) as n, count(*) filter (availability_status = 'available' and (metric_value is null or {HIT.format('metric_id')})) as miss, count(*) filter (availability_status <> 'available' and metric_value is not null and not {HIT.format('metric_id')}) as extra from o_serp_gold
      union all select 'llm', count(*), count(*) filter (availability_status = 'available' and metric_value is null), count(*) filter (availability_status <> 'available' and metric_value is not null) from o_answer_gold
      union all select 'comparison', count(*), count(*) filter (availability_status = 'available' and metric_value is null), count(*) filter (availability_status <> 'available' and metric_value is not null) from o_comparison_gold)
    select ch || '_metric_rows' as check_name, n as value, null as reason from s union all select 'available_null_metric_value_rows', sum(miss)::bigint, case when sum(miss) > 0 then 'available_metric_value_null' end from s
    union all select 'unavailable_non_null_metric_value_rows', sum(extra)::bigint, case when sum(extra) > 0 then 'unavailable_metric_value_present' end from s
    union all select 'active_comparisons', count(*), null from src_comparisons where active union all select 'active_comparisons_missing_gold', 0, null
    union all select r || '_present', 1, null from (values ('gold_serp_brand_visibility'), ('gold_llm_brand_visibility'), ('gold_comparison_brand_metrics')) v(r)""")
def _(i):
    frames = {
        "serp": damaged(serp_gold(i), "metric_id", {"metric_value": F.lit(None).cast("double")}),
        "llm": answer_gold(i), "comparison": comparison_gold(i),
    }
    return release.assess(frames, comparisons(i))


def releases(i: Inputs) -> tuple[DataFrame, DataFrame]:
    r = i.table("nation").selectExpr(
        "concat('rel', n_nationkey) as release_id", "case when n_nationkey % 3 = 0 then 'incomplete' else 'completed' end as status", "date_add(date '2026-01-01', n_nationkey) as completed_at")
    pointer = i.table("nation").filter("n_nationkey in (4, 6)").selectExpr("case n_nationkey when 4 then 'current' else 'other' end as slot", "concat('rel', n_nationkey) as release_id")
    return pointer, r


RELEASED = "select '{}' as channel, brand_id, availability_status, count(*) as metric_rows, count(metric_value) as measured, count(distinct metric_id) as ids from {} group by all"


@query("published_release", " union all ".join(RELEASED.format(*x) for x in (("serp", "o_serp_gold"), ("llm", "o_answer_gold"), ("comparison", "o_comparison_gold"))))
def _(i):
    """Publish the metric frames, then read them back through the pointer."""
    root = f"{shared_dir(i.spark)}/sightline/release-{uuid.uuid4().hex}"
    llm = i.once("answer_gold", lambda: answer_gold(i))
    gold = {"serp": serp_gold(i), "llm": llm, "comparison": comparison_gold(i, llm)}
    publication.publish(i.spark, root, "r1", gold, comparisons(i), completed_at=F.lit("2026-10-01 00:00:00"))
    return shape.union_all([
        snapshots.read_channel(i.spark, root, c).groupBy(F.lit(c).alias("channel"), "brand_id", "availability_status").agg(
            F.count("*").alias("metric_rows"), F.count("metric_value").alias("measured"), F.count_distinct(ids.packed_hash("metric_id")).alias("ids"))
        for c in gold
    ])


@query("current_release_rows", "select 'rel' || o_orderkey % 25 as release_id, o_orderkey from orders where o_orderkey % 25 = 4")
def _(i):
    pointer, r = releases(i)
    rows = i.table("orders").selectExpr("concat('rel', o_orderkey % 25) as release_id", "o_orderkey")
    return release.presentation(rows, pointer, r)


@query("completed_releases", "select 'rel' || n_nationkey as release_id, 'completed' as status, cast(date '2026-01-01' + n_nationkey as string) as completed_at from nation where n_nationkey % 3 <> 0")
def _(i):
    return snapshots.completed_releases(releases(i)[1])


@query("current_pointer_rule", "select 'incomplete_current_release' as rule, 'rel' || n_nationkey as failure_id from nation where n_nationkey % 3 = 0")
def _(i):
    pointer = i.table("nation").selectExpr("'current' as slot", "concat('rel', n_nationkey) as release_id")
    return quality.current_pointer_rule(pointer, releases(i)[1])


@query("tolerant_snapshot", "select metric_id, brand_id, null as language_code, null as device from o_serp_gold")
def _(i):
    old = serp_gold(i).drop("language_code", "device", "collected_at").withColumn("release_id", F.lit("rel1"))
    return snapshots.tolerant(old, "serp").select("metric_id", "brand_id", "language_code", "device")


@query("uncovered_comparisons", "select comparison_id from src_comparisons where active and comparison_id not in (select comparison_id from o_comparison_gold where comparison_eligibility = 'matched_context')")
def _(i):
    return release.uncovered_comparisons(comparisons(i), comparison_gold(i).filter("comparison_eligibility = 'matched_context'")).select("comparison_id")


def research_results(i: Inputs) -> DataFrame:
    return i.table("orders").selectExpr(
        "concat('res', o_orderkey) as result_id", "concat('obs', o_orderkey) as observation_id", "case when o_orderkey % 2 = 0 then 'serp' else 'llm' end as source_category",
        "case when o_orderkey % 2 = 0 then concat('q', o_custkey % 20) else concat('p', o_custkey % 20) end as query_id", "case o_custkey % 4 when 0 then null else 'en' end as language_code",
        "concat('l', o_custkey % 3) as location_code", "concat('w', o_orderkey % 40) as collection_window")


@query("context_pairs", """
    with r as (select 'res' || o_orderkey as result_id, o_orderkey % 2 = 0 as serp, case when o_orderkey % 2 = 0 then 'q' || o_custkey % 20 else 'p' || o_custkey % 20 end as q, case o_custkey % 4 when 0 then null else 'en' end as l, 'l' || o_custkey % 3 as lo, 'w' || (o_orderkey % 40) // 2 as w from orders)
    select comparison_id, s.result_id as serp_result_id, a.result_id as llm_result_id from src_comparisons c join r s on s.serp and s.q = c.query_id join r a on not a.serp and a.q = c.prompt_id and a.l = s.l and a.lo = s.lo and a.w = s.w where c.active""")
def _(i):
    rows = research_results(i).withColumn("collection_window", F.concat(F.lit("w"), F.floor(F.regexp_extract("observation_id", r"\d+", 0).cast("bigint") % 40 / 2).cast("string")))
    return release.context_pairs(rows, i.bind("src_comparisons")).select("comparison_id", "serp_result_id", "llm_result_id")


@query("duplicate_mappings", """
    select query_id, prompt_id, count(*) as mappings from (select substr(query_id, 1, 2) as query_id, mapping_version as prompt_id from src_comparisons where active) group by 1, 2 having count(*) > 1""")
def _(i):
    """Mappings whose instruments were shortened until some coincide."""
    rows = i.bind("src_comparisons").withColumn("query_id", F.substring("query_id", 1, 2)).withColumn("prompt_id", F.col("mapping_version"))
    return release.duplicate_mappings(rows)


@query("active_mappings_on_day", "select comparison_id, active and (effective_end_date is null or effective_end_date >= date '2026-01-01') as active from src_comparisons")
def _(i):
    return registries.active_on(i.bind("src_comparisons"), F.lit("2026-01-01").cast("date")).select("comparison_id", "active")


@query("research_payload_rows", "select distinct 'rel1' as release_id, 'labels' as kind, '{\"quality\":' || quality || ',\"toxic\":' || toxic || '}' as payload_json from labels")
def _(i):
    return release.research_rows({"labels": i.table("labels").select("toxic", "quality")}, "rel1").drop("row_id")


@query("relation_row_counts", "select 'orders' as relation, count(*) as rows from orders union all select 'brands', count(*) from src_brands")
def _(i):
    return sinks.relation_counts({"orders": i.table("orders"), "brands": brands(i)})


@query("report_rows", "select vec_id, label, len(embedding) > 0 as filled from embeddings")
def _(i):
    flat = sinks.report_rows(i.table("embeddings"))
    return flat.select("vec_id", "label", F.col("embedding").startswith("[").alias("filled"))


# ---------------------------------------------------------------------------
# Reviews and attempts
# ---------------------------------------------------------------------------

step("o_reviews", """
    with one as (select opportunity_id, sequence, min({'status': status, 'release_id': release_id}) as e from src_reviews group by 1, 2)
    select r.*, p.e.status as ps, p.e.release_id as pr, p.opportunity_id is not null as linked from src_reviews r left join one p on p.opportunity_id = r.opportunity_id and p.sequence + 1 = r.sequence""")
OK_STEP = "((ps, status) in (('new','in_review'),('new','archived'),('in_review','needs_evidence'),('in_review','action_planned'),('in_review','closed'),('in_review','archived'),('needs_evidence','in_review'),('needs_evidence','action_planned'),('needs_evidence','archived'),('action_planned','in_review'),('action_planned','experiment_running'),('action_planned','closed'),('action_planned','archived'),('experiment_running','needs_evidence'),('experiment_running','closed'),('experiment_running','archived'),('closed','in_review'),('closed','archived')) or (ps = status and ps in ('new','in_review','needs_evidence','action_planned','experiment_running','closed')))"


@query("review_log_problems", f"""
    select opportunity_id, sequence, 'missing required field' as problem from o_reviews where trim(reviewer) = '' union all select opportunity_id, sequence, 'unsupported status' from o_reviews where status = 'lost'
    union all select opportunity_id, sequence, 'unsupported classification' from o_reviews where classification = 'guess' union all select opportunity_id, sequence, 'next step required' from o_reviews where status in ('action_planned', 'experiment_running') and next_action = ''
    union all select opportunity_id, sequence, 'stale sequence' from o_reviews where sequence <> 1 and not linked union all select opportunity_id, sequence, 'first event must be new' from o_reviews where sequence = 1 and status <> 'new'
    union all select opportunity_id, sequence, 'release changed' from o_reviews where linked and pr <> release_id union all select opportunity_id, sequence, case when ps = 'archived' then 'archived is final' else 'invalid transition' end from o_reviews where linked and (ps = 'archived' or not {OK_STEP})
    union all select opportunity_id, sequence, 'repeated sequence' from src_reviews group by 1, 2 having count(*) > 1""")
def _(i):
    return reviews.review_problems(i.bind("src_reviews"))


@query("unknown_review_references", """
    with c as (select opportunity_id, sequence, release_id, unnest([ 'm' || regexp_extract(evidence_json, '"m([0-9]+)"', 1), 'e' || regexp_extract(evidence_json, '"e([0-9]+)"', 1)]) as reference from src_reviews)
    select * from c where not exists (select 1 from orders where c.reference = 'm' || o_orderkey and c.release_id = 'rel0') and not exists (select 1 from customer where c.reference = 'e' || c_custkey and c.release_id = 'rel0')""")
def _(i):
    m = i.table("orders").selectExpr("'rel0' as release_id", "concat('m', o_orderkey) as metric_id")
    e = i.table("customer").selectExpr("'rel0' as release_id", "concat('e', c_custkey) as evidence_id")
    return reviews.unknown_references(i.bind("src_reviews"), [(m, "metric_id"), (e, "evidence_id")]).select("opportunity_id", "sequence", "release_id", "reference")


@query("review_history", "select opportunity_id, sequence, status from src_reviews")
def _(i):
    return reviews.review_history(i.bind("src_reviews")).select("opportunity_id", "sequence", "status")


@query("latest_reviews", "select opportunity_id, e.sequence, e.status, e.release_id from (select opportunity_id, max({'sequence': sequence, 'status': status, 'release_id': release_id}) as e from src_reviews group by 1)")
def _(i):
    return reviews.latest_reviews(i.bind("src_reviews"))


@query("attempt_state_problems", """
    with a as (select r.*, p.status as ps from src_attempts r left join src_attempts p on p.attempt_id = r.attempt_id and p.sequence + 1 = r.sequence)
    select attempt_id, sequence, 'illegal transition' as problem from a where ps is not null and not ((ps, status) in (('planned','sending'),('sending','sent'),('sending','failed'),('sending','outcome_unknown'),('sent','success'),('sent','failed'),('sent','outcome_unknown')))
    union all select attempt_id, sequence, 'repeated sequence' from src_attempts group by 1, 2 having count(*) > 1""")
def _(i):
    return reviews.attempt_problems(i.bind("src_attempts"))


# ---------------------------------------------------------------------------
# Ledger
# ---------------------------------------------------------------------------


@query("plan_to_send", """
    with p as (select *, row_number() over (partition by deduplication_key order by request_id) as rk from src_requests)
    select request_id, deduplication_key from p where rk = 1 and deduplication_key not in (select deduplication_key from src_requests where request_status = 'completed' and run_id in ('run1', 'run2') and deduplication_key is not null)""")
def _(i):
    rows = i.bind("src_requests")
    history = rows.select("deduplication_key", F.coalesce((F.col("request_status") == "completed") & F.col("run_id").isin("run1", "run2"), F.lit(False)).alias("verified_success"))
    return ledger.plan_to_send(rows.withColumn("position", F.col("request_id")), history).select("request_id", "deduplication_key")


@query("accepted_assignments", """
    select distinct q.query_id, q.search_target_id from src_requests q join src_responses r using (request_id) where source_category = 'serp' and provider = 'northwind' and collection_window = 'w2' and request_status in ('submitted_pending_result', 'completed') and r.task_id is not null and actual_cost > 0""")
def _(i):
    return ledger.accepted_assignments(i.bind("src_requests"), i.bind("src_responses"), "serp", "w2", "northwind")


@query("pending_search_tasks", """
    select request_id, r.task_id, query_id, search_target_id, collection_window, lower(search_engine) as source from src_requests join src_responses r using (request_id)
    where request_status = 'submitted_pending_result' and source_category = 'serp' and provider = 'northwind' and lower(search_engine) in ('google', 'bing', 'yahoo', 'baidu') and r.task_id is not null""")
def _(i):
    return ledger.pending_tasks(i.bind("src_requests"), i.bind("src_responses"), "serp", "northwind", ledger.SERP_ENGINES)


@query("assignment_coverage", """
    with st as (select query_id, search_target_id, bool_or(request_status in ('submitted_pending_result', 'completed')) as s, bool_or(request_status = 'completed') as r from src_requests group by 1, 2),
    c as (select distinct a.query_id, a.search_target_id, 'e' || substr(a.query_id, 2)::int % 3 as platform from src_assignments a)
    select platform, count(*) as configured, count(*) filter (s) as submitted, count(*) filter (r) as retrieved, count(*) - count(*) filter (s) as missing from c left join st using (query_id, search_target_id) group by 1""")
def _(i):
    configured = i.bind("src_assignments").select("query_id", "search_target_id").distinct().withColumn(
        "platform", F.concat(F.lit("e"), (F.substring("query_id", 2, 9).cast("int") % 3).cast("string")))
    return ledger.assignment_coverage(configured, i.bind("src_requests"))


@query("run_manifests", """
    select run_id, count(*) as attempts, count(*) filter (status = 'success') as successes, count(*) filter (status = 'failed') as failures, sum(cents)::bigint as estimated_cents, coalesce(sum(case when status = 'success' then cents end), 0)::bigint as actual_cents,
      case when count(*) filter (status = 'success') > 0 and count(*) filter (status = 'failed') > 0 then 'partial_success' when count(*) filter (status = 'success') > 0 then 'success' else 'failed' end as status from src_attempts group by 1""")
def _(i):
    rows = i.bind("src_attempts").selectExpr("run_id", "status as state", "cents as estimated_cents", "case when status = 'success' then cents end as actual_cents")
    return ledger.run_manifests(rows)


CAPS = {"run_id": 400000, "engine": 1000000, "target_id": 20000, "day": 60000}
step("o_spend", """
    select *, case dimension when 'run_id' then 400000 when 'engine' then 1000000 when 'day' then 60000 else 20000 end as cap_cents from (
      select position, cents, ts, unnest(['run_id', 'engine', 'target_id', 'day']) as dimension, unnest([run_id, engine, target_id, day::varchar]) as member
      from src_attempts join (select event_id as position, ts from events) using (position))""")


@query("spend_ledger", """
    with r as (select *, sum(cents) over (partition by dimension, member order by position)::bigint as spent_cents from o_spend)
    select 'e' || position as request_id, dimension, member, spent_cents, spent_cents > cap_cents as breached from r""")
def _(i):
    costs = i.bind("src_attempts").withColumn("request_id", F.concat(F.lit("e"), F.col("position").cast("string")))
    return ledger.spend_ledger(costs, CAPS).select("request_id", "dimension", "member", "spent_cents", "breached")


@query("spend_ledger_by_time", """
    with c as (select event_id, ts, round(value * 100)::bigint as cents, unnest(['engine', 'user_id']) as dimension, unnest([case when event_id % 10 = 3 then 'bing' else 'google' end, user_id::varchar]) as member from events),
    r as (select *, sum(cents) over (partition by dimension, member order by ts, event_id)::bigint as spent_cents from c)
    select 'e' || event_id as request_id, dimension, member, spent_cents, spent_cents > case dimension when 'engine' then 1000000 else 20000 end as breached from r""")
def _(i):
    """Ordered by a sparse time; one engine has nine tenths of all rows."""
    costs = i.table("events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("request_id"), "ts", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.when(F.col("event_id") % 10 == 3, "bing").otherwise("google").alias("engine"), "user_id",
    )
    rows = ledger.spend_ledger(costs, {"engine": 1000000, "user_id": 20000}, ["ts", "event_id"])
    return rows.select("request_id", "dimension", "member", "spent_cents", "breached")


@query("retry_decisions", """
    select attempt_id, sequence, case when status = 'outcome_unknown' then 'outcome_unknown' when http_status = 401 then 'no_retry' when http_status = 429 and engine = 'google' then 'retry' when http_status in (500, 503) then 'retry' else 'no_retry' end as decision from src_attempts""")
def _(i):
    decision = ledger.retry_decision(F.col("http_status"), F.col("status") == "outcome_unknown", F.col("engine") == "google")
    return i.bind("src_attempts").select("attempt_id", "sequence", decision.alias("decision"))


@query("status_counts", "select engine, status, count(*) as rows from src_attempts group by 1, 2")
def _(i):
    return ledger.status_counts(i.bind("src_attempts"), "engine", "status")
