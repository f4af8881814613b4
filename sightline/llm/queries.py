"""The operators of this subpackage as named queries over whole tables, and their checking SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import fingerprints, languages, lexical_search, licences, merkle, mixing, near_dups, packing, pii, token_files, toxicity, url_rules, vectors
from sightline.llm.tables import held_out, shared_folder, stored, table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_neighbours(table(spark, folder, "documents"))


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages").select("page_id", "url"), url_rules.rule_table(spark)).drop("url")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.draw_plan(table(spark, folder, "documents"))
    taken = (F.col("size") * F.size("places")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, F.transform("places", lambda p: p["shard"]).alias("shards"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, folder, "documents"), files)
    read = token_files.read_token_files(spark, files)
    read = read.select("shard", "block", "nth", "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    starts = token_files.token_offsets(spark, files)
    return stored(read, "token-read").join(stored(starts, "token-starts"), ["shard", "block", "nth"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    network, trees = toxicity.fit(docs, labels, lambda name: ~held_out(name, 4, 2))
    rows = toxicity.score(docs.select("doc_id", "text"), network, trees)
    return rows.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= toxicity.CUT).cast("int").alias("predicted"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.pack(table(spark, folder, "documents"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.link_vectors(table(spark, folder, "embeddings"), loss=vectors.LOSS)


def op10_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trees = languages.fit(docs, ~held_out("doc_id", 5, 0))
    rows = languages.identify(docs.select("doc_id", "text"), trees)
    return rows.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op11_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents")).drop("notices")


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = {"n_chars": F.col("n_chars") + 1}
    rows = merkle.versions(table(spark, folder, "documents"), tampered, held_out("doc_id", 7, 0))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_fingerprints, op3_url_rules, op4_mixing, op5_token_files, op6_toxicity, op7_near_duplicates, op8_packing, op9_vectors,
        op10_languages, op11_licences, op12_merkle, op13_lexical_search,
    )
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BASE = ", ".join(f"('{text}', '{label}')" for text, label in licences.BASE)
_NOTICES = ", ".join(f"({t}, '{label}', '{text}', {list(licences.notice(label, text, keys).needed)})" for t, (label, text, keys) in enumerate(licences.NOTICES))
_FIELD = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}::varchar, '-')"
_LEAF, _BENT = (" || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) for n_chars in ("n_chars", "(n_chars + 1)"))
_SIBLING = "case when b.hash is null then '' when b.idx < a.idx then 'l' || b.hash else 'r' || b.hash end"
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)

ORACLES = {
    "op3_url_rules": rf"""
        with parts as (
            select page_id,
                coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
            from pages),
        rules(rule_host, rule_path, verdict) as (values {_RULES}),
        fits as (
            select page_id, rule_host || rule_path as rule, verdict,
                row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc, verdict desc) as nth
            from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
        select parts.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
        from parts left join fits on fits.page_id = parts.page_id and nth = 1""",
    "op7_near_duplicates": r"""
        with recursive texts as materialized (
            select coalesce(text, '') as text, min(doc_id) as id, count(*) as n from documents group by 1),
        words as (select id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from texts),
        shingles as materialized (
            select distinct id, array_to_string(w[i:i + 4], ' ') as s
            from (select id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)),
        sizes as materialized (select id, count(*) as n from shingles group by id),
        common as (select a.id as a, b.id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.id < b.id group by 1, 2),
        links as materialized (
            select a, b from common join sizes x on x.id = a join sizes y on y.id = b where c >= 0.8 * (x.n + y.n - c)),
        both_ways as materialized (select a, b from links union all select b, a from links),
        reach(id, root) as (
            select id, id from texts union select both_ways.b, reach.root from reach join both_ways on both_ways.a = reach.id),
        classes as (select id, min(root) as class_id from reach group by id)
        select doc_id, class_id, n as n_copies, doc_id = class_id as kept
        from documents join texts on texts.text = coalesce(documents.text, '') join classes on classes.id = texts.id""",
    "op9_vectors": r"""
        with recursive v as materialized (
            select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
        good as materialized (
            select vec_id, e from v where e is not null and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
        links as materialized (
            select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id
            where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
        reach(id, root) as (select vec_id, vec_id from v union select b, root from reach join links on a = id),
        found as (select id, min(root) as component_id from reach group by id)
        select v.vec_id, (select count(*) from links where a = v.vec_id) as n_links, component_id, v.vec_id = component_id as kept
        from v join found on found.id = v.vec_id""",
    "op11_licences": rf"""
        with texts as materialized (
            select row_number() over () as r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        notices(t, label, text, needed) as (values {_NOTICES}),
        phrases(text, label) as (values {_BASE}),
        postings as materialized (
            select t, label, word, q - 1 as q, len(w) as size, list_contains(needed, q - 1) as needed
            from (select t, label, needed, string_split(text, ' ') as w from notices), lateral (select unnest(w) as word, generate_subscripts(w, 1) as q)),
        base as (
            select label, word, q - 1 as q, len(w) as size
            from (select label, string_split(text, ' ') as w from phrases), lateral (select unnest(w) as word, generate_subscripts(w, 1) as q)),
        hits as materialized (
            select r, p - 1 as p, word from (select r, unnest(w) as word, generate_subscripts(w, 1) as p from texts)
            where word in (select word from postings union select word from base)),
        holding as (select word, count(distinct r) as n from hits group by word),
        rare as (
            select r, word from (
                select r, word, row_number() over (partition by r order by n, word) as nth from (select distinct r, word from hits) join holding using (word))
            where nth <= {licences.RARE}),
        votes as (
            select r, t, p - q as start from hits semi join rare using (r, word) join postings using (word)
            group by all having count(distinct word) >= {licences.AGREEING}),
        held as (
            select votes.r, t, start, any_value(label) as label, count(p) / any_value(size) as share
            from votes join postings using (t) left join hits on hits.r = votes.r and p = start + q and hits.word = postings.word
            group by votes.r, t, start having bool_and(p is not null or not needed) and count(p) / any_value(size) >= {licences.SHARE}),
        found as (select r, list(distinct label) as labels, max(share) as share from held group by r),
        places as (select r, label, p - q as start from hits join base using (word) group by r, label, p - q, size having count(distinct q) = size),
        counted as (select r, count(*) as n, min(start) as low, max(start) as high, list(distinct label) as labels from places group by r)
        select doc_id, len(w) as n_words, coalesce(n, 0) as n_base, low as first_word, high as last_word,
            coalesce(array_to_string(list_sort(counted.labels), ','), '') as base_labels,
            coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(counted.labels, []), coalesce(found.labels, [])))), ','), '') as labels,
            case when n > 0 then 1.0::double else coalesce(share, 0)::double end as score
        from texts left join counted using (r) left join found using (r)""",
    "op12_merkle": rf"""
        with recursive d as materialized (
            select doc_id, lang, leaf, case when crc % 7 = 0 then bent else leaf end as now,
                row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n
            from (
                select doc_id, lang, sha256({_LEAF}) as leaf, sha256({_BENT}) as bent,
                    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''),
                        lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
                        lambda c, e: case when e >= 0 then xor(c, e) else xor(c >> 1, 3988292384 * (c & 1)) end)) as crc
                from documents)),
        low(lang, level, idx, hash, n) as (
            select lang, 0, idx, leaf, n from d
            union all
            select lang, any_value(level) + 1, idx // 2, sha256(string_agg(hash, '' order by idx)), (any_value(n) + 1) // 2 from low where n > 1 group by lang, idx // 2),
        top(level, idx, hash, n, lang) as (
            select 0, row_number() over (order by lang nulls first) - 1, hash, count(*) over (), lang from low where n = 1
            union all
            select any_value(level) + 1, idx // 2, sha256(string_agg(hash, '' order by idx)), (any_value(n) + 1) // 2, null from top where n > 1 group by idx // 2),
        subroots as materialized (select lang, idx, hash from top where level = 0),
        low_steps as materialized (
            select a.lang, a.level, a.idx, {_SIBLING} as step
            from low a left join low b on a.lang is not distinct from b.lang and a.level = b.level and b.idx = xor(a.idx, 1) where a.n > 1),
        top_steps as materialized (
            select a.level, a.idx, {_SIBLING} as step from top a left join top b on a.level = b.level and b.idx = xor(a.idx, 1) where a.n > 1),
        steps as (
            select d.idx, d.lang, s.level, s.step from d join low_steps s on d.lang is not distinct from s.lang and s.idx = d.idx >> s.level
            union all
            select d.idx, d.lang, 1000 + t.level, t.step from d join subroots r on d.lang is not distinct from r.lang join top_steps t on t.idx = r.idx >> t.level),
        paths as materialized (select idx, lang, list(step order by level) as path from steps group by idx, lang),
        folded as (
            select d.*, r.hash as subroot, (select hash from top where n = 1) as root, coalesce(path, []) as path,
                list_reduce(list_prepend(now, coalesce(path, [])),
                    lambda acc, s: sha256(case when s[1] = 'l' then s[2:] || acc else acc || s[2:] end)) as folded_root
            from d join subroots r on d.lang is not distinct from r.lang left join paths p on p.idx = d.idx and p.lang is not distinct from d.lang)
        select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) as proof_sha256, folded_root, folded_root = root as verified
        from folded""",
    "op13_lexical_search": rf"""
        with terms as materialized (
            select r, doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
            from (select row_number() over () as r, doc_id, text from documents)),
        sizes as materialized (select r, any_value(doc_id) as doc_id, count(*) as n from terms group by r),
        total as (select count(*) as docs, sum(n)::bigint as words from sizes),
        counts as materialized (select r, term, count(*) as tf from terms group by r, term),
        weights as (
            select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counts, total group by term),
        items as (
            select i, item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
            from (select row_number() over () as i, item_id, text from benchmark)),
        wanted as (select i, any_value(item_id) as item_id, term, count(*) as times from items group by i, term),
        scores as (
            select i, any_value(item_id) as item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::bigint as score
            from wanted join counts using (term) join weights using (term) join sizes using (r), total group by i, r)
        select item_id, rank::int as rank, doc_id, score
        from (select item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank from scores join sizes using (r) where score > 0)
        where rank <= 10""",
}
