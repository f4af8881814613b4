"""Trees are walked in one pass of narrow steps, and queries that use them once store nothing."""

import os

import pytest
from pyspark.sql import functions as F

from sightline.functions import ids, jsonx
from sightline.functions.url import hostname
from sightline.operators import evidence, tree
from sightline.plans import evidence_queries as eq
from sightline.plans.bindings import Inputs
from sightline.session import configure

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_nodes_and_their_fallback_come_from_one_pass(spark):
    i = Inputs(configure(spark), FOLDER)
    results = eq.results(i)
    nodes = evidence.collect_nodes(results)
    assert "Join" not in plan(nodes) and plan(nodes).count("FileScan") == 1
    walked = tree.walk(results, tree.FEATURE_GRAMMAR)
    wanted = walked.unionByName(evidence.fallback_nodes(results, walked)).select("item_id", "json_path", "item_kind", "depth", "is_top_level")
    found = nodes.select(*wanted.columns)
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()
    assert not found.filter("json_path like '%].markdown'").isEmpty()


@needs_tables
def test_queries_read_only_the_payload_fields_they_need_and_store_nothing(spark):
    import __spark_entry__ as entry

    for name in ("evidence_tree", "evidence_items", "citation_occurrences", "product_brand_candidates", "item_view_counts"):
        shown = plan(entry.queries()[name](spark, FOLDER))
        assert shown.count("FileScan") == 1 and "orders.parquet" in shown
    assert "raw_evidence_json" not in plan(eq.fresh_items(Inputs(configure(spark), FOLDER)).select("item_id", "title"))


def test_nested_members_and_presence(spark):
    texts = ['{"a":1,"b":"[{"}', '{"a":{}}', '{"a":[]}', '{"a":null}', "[[1]]", "7", '{"b":{"c":[1]},"a":"x"}', None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").withColumn("v", jsonx.parse("t"))
    got = rows.select(
        "n", jsonx.has_nested("v").alias("nested"), jsonx.present("v", "$.a").alias("a"),
        F.transform(jsonx.nested_entries("v"), lambda e: e["key"]).alias("keys"),
    ).orderBy("n").collect()
    assert [r.nested for r in got] == [False, True, True, False, False, False, True, False]
    assert [r.a for r in got] == [True, True, True, True, False, False, True, False]
    assert [r["keys"] for r in got] == [[], ["a"], ["a"], [], None, None, ["b"], None]


def test_json_strings_and_hosts_of_any_letters(spark):
    texts = ['plain ~ text', 'a"b', "a\\b", "é", "\x7f", "tab\t", "", None, "a/b", "line\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.to_json(F.array("t"))
    differs = ~ids.json_string("t").eqNullSafe(F.when(F.col("t").isNull(), "null").otherwise(F.substring(whole, F.lit(2), F.length(whole) - 2)))
    assert rows.filter(differs).isEmpty()
    hosts = spark.createDataFrame([("https://WWW.Ab.com/x",), ("https://ÀB.com",), ("https://ab.com.",), ("https://:80/",), ("",)], "u string")
    assert [r.h for r in hosts.select(hostname("u").alias("h")).collect()] == ["www.ab.com", "àb.com", "ab.com", None, None]


def test_trees_deeper_than_the_steps_within_a_row(spark):
    inner = '{"type":"x","references":[{"url":"http://a.b/c"}]}'
    for _ in range(45):
        inner = '{"type":"organic","images":[' + inner + "]}"
    rows = spark.createDataFrame([('{"items":[' + inner + "]}",)], "j string").selectExpr(
        "'o' as observation_id", "'r' as result_id", "'serp' as source_category", "'$' as json_path", "parse_json(j) as result"
    )
    found = tree.walk(rows, tree.FEATURE_GRAMMAR)
    assert plan(found).count("Scan parquet") == 0
    kinds = found.groupBy("item_kind").agg(F.count("*"), F.max("depth")).collect()
    assert sorted(tuple(r) for r in kinds) == [("citation", 1, 46), ("image", 45, 45), ("organic", 1, 0)]


@needs_tables
def test_files_are_not_broadcast_to_their_manifests(spark):
    import __spark_entry__ as entry

    shown = plan(entry.queries()["manifest_verification"](spark, FOLDER))
    assert "SortMergeJoin" in shown and "Broadcast" not in shown
