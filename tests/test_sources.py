import datetime as dt
import hashlib
import json
import os
import uuid
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sightline import schemas
from sightline.operators import ledger, payloads, publication, release, research_snapshot, reviews, staging, tree
from sightline.operators.shape import dense_grain, latest_per
from sightline.session import shared_dir
from sightline.sources import claims, raw, registries, sinks, snapshots
from sightline.streaming import ingest


def write_triple(root, category, day, request, *, body=None, break_hash=False, aux=None):
    directory = f"{root}/{category}/northwind/google/{day}/run1/{request}"
    os.makedirs(directory)
    files = {"request.json": b'{"q":1}', "response.json": body or b'{"a":1,"b":2}'}
    manifest = {
        n: {"sha256": "bad" if break_hash else hashlib.sha256(c).hexdigest(), "byte_size": len(c), "content_type": "application/json"}
        for n, c in files.items()
    }
    meta = {
        "source_category": category, "provider": "northwind", "platform_or_engine": "google", "run_id": "run1",
        "request_id": request, "collected_at": "2026-09-28T10:00:00+00:00", "files": manifest,
    }
    files["metadata.json"] = json.dumps(meta).encode()
    if aux:
        files["copy.json"] = aux
    for name, content in files.items():
        with open(f"{directory}/{name}", "wb") as handle:
            handle.write(content)


def test_raw_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_triple(root, "serp", "2026/09/28", "good", aux=b'{"b": 2, "a": 1}')
    write_triple(root, "llm", "2026/10/02", "bad", break_hash=True)
    os.makedirs(f"{root}/serp/northwind/google/2026/09/28/run1/orphan")
    with open(f"{root}/serp/northwind/google/2026/09/28/run1/orphan/response.json", "wb") as handle:
        handle.write(b'{"x":')
    files = raw.inventory(raw.read_raw(spark, root))
    assert files.count() == 8
    states = {r.path.rsplit("run1/", 1)[1]: r.disposition for r in raw.dispositions(files).collect()}
    assert states["good/response.json"] == "verified_response_candidate"
    assert states["good/copy.json"] == "duplicate_response_representation"
    assert states["bad/response.json"] == "quarantined_integrity"
    assert states["orphan/response.json"] == "quarantined_integrity"
    assert {r.result for r in raw.verify_manifest(files).collect()} == {"verified", "checksum_mismatch"}
    assert raw.incomplete_directories(files).count() == 1
    assert raw.inventory(raw.read_raw(spark, root, "2026-10-02")).count() == 3


def test_registry_csv(spark, tmp_path):
    path = tmp_path / "queries.csv"
    path.write_text("﻿query_id,keyword,language,market,active\nq1,shoes,en,US,TRUE\nq2,hats,en,US,maybe\n", encoding="utf-8")
    rows = {r.query_id: r for r in registries.load_registry(spark, str(path), "queries").collect()}
    assert rows["q1"].active is True and rows["q1"].problems == []
    assert rows["q2"].active is None and rows["q2"].problems == ["active"]
    with pytest.raises(registries.RegistryError):
        registries.load_registry(spark, str(path), "brands")


def test_registry_version_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    b = a.orderBy(F.desc("id"))
    version = lambda df: registries.registry_version({"brands": df}).first()[0]
    assert version(a) == version(b) != version(a.filter("id = 1"))


def gold(spark):
    common = "metric_id string, brand_id string, brand_canonical_name string, metric_name string, metric_version string, availability_status string, metric_value double, collected_at timestamp"
    base = ("m1", "b1", "Brand", "serp_organic_sov", "1.0.0", "available", 0.5, None)
    one = spark.createDataFrame([base], common)
    columns = {c for k in ("serp", "llm", "comparison") for c in (*schemas.snapshot_required(k), *schemas.METRIC_CONTEXT[k])}
    for c in sorted(columns - set(one.columns) - {"release_id"}):
        one = one.withColumn(c, F.lit("c1" if c == "comparison_id" else None).cast("string"))
    one = one.withColumn("raw_language_code", F.lit("en"))
    return {"serp": one, "llm": one, "comparison": one}


def covered(spark):
    return spark.createDataFrame([("c1", "q", "p", True)], "comparison_id string, query_id string, prompt_id string, active boolean")


def test_publish_is_immutable_and_read_through_the_pointer(spark, tmp_path):
    root, comparisons = str(tmp_path / "release"), covered(spark)
    publication.publish(spark, root, "r1", gold(spark), comparisons, completed_at=F.lit("2026-10-01 00:00:00"))
    with pytest.raises(release.ReleaseError, match="published already"):
        publication.publish(spark, root, "r1", gold(spark), comparisons, completed_at=F.lit("2026-10-01 00:00:00"))
    with pytest.raises(release.ReleaseError, match="active_comparison_missing_gold_metrics"):
        publication.publish(spark, root, "r2", gold(spark), comparisons.withColumn("comparison_id", F.lit("zz")), completed_at=F.lit("2026-10-01 00:00:00"))
    pointer, done = publication.pointer(spark, root), publication.records(spark, root)
    assert snapshots.choose_release(pointer, done) == "r1" and done.first().completed_at.year == 2026
    assert snapshots.read_channel(spark, root, "serp").count() == 1
    with pytest.raises(snapshots.SnapshotError):
        snapshots.choose_release(pointer, done, "r2")
    with pytest.raises(release.ReleaseError):
        publication.point_to(spark, root, "r2")
    publication.publish(spark, root, "r2", gold(spark), comparisons, completed_at=F.lit("2026-10-01 00:00:00"))
    assert snapshots.choose_release(publication.pointer(spark, root), publication.records(spark, root)) == "r2"
    publication.point_to(spark, root, "r1")
    assert publication.pointer(spark, root).first().release_id == "r1"


def test_a_failed_publication_is_unseen_and_can_be_retried(spark, tmp_path):
    root, comparisons, good = str(tmp_path / "release"), covered(spark), gold(spark)
    broken = {**good, "comparison": good["comparison"].withColumn("device", F.raise_error(F.lit("lost disk")).cast("string"))}
    with pytest.raises(Exception, match="lost disk"):
        publication.publish(spark, root, "r1", broken, comparisons, completed_at=F.lit("2026-10-01 00:00:00"))
    assert os.path.isdir(f"{root}/serp/release_id=r1")  # the first frame was written
    assert publication.records(spark, root).isEmpty() and publication.pointer(spark, root).isEmpty()
    with pytest.raises(release.ReleaseError):
        publication.released(spark, root, "serp", "r1")
    attempt = publication.publish(spark, root, "r1", good, comparisons, completed_at=F.lit("2026-10-01 00:00:00"))
    assert publication.released(spark, root, "serp").count() == 1  # not that of the failed attempt
    assert len(os.listdir(f"{root}/serp/release_id=r1")) == 2 and os.path.isdir(f"{root}/comparison/release_id=r1/attempt={attempt}")


def test_one_claim_wins(spark, tmp_path):
    folder = str(tmp_path / "claims")
    assert claims.claim(spark, folder, "a.json", {"release_id": "a", "sequence": 1})
    assert not claims.claim(spark, folder, "a.json", {"release_id": "b", "sequence": 2})
    assert [r.release_id for r in claims.claims(spark, folder, publication.MOVE).collect()] == ["a"]
    assert claims.claims(spark, str(tmp_path / "none"), publication.MOVE).isEmpty()


CONTEXT = "observation_id string, raw_file_hash string, collection_window string, response_id string, provider string, language_code string, location_code string, instrument_id string, engine_or_platform string, source_category string"
RESULT = "result_id string, observation_id string, source_category string, query_id string, provider string, engine_or_platform string, language_code string, location_code string, raw_file_hash string, response_id string"
MATCH = "evidence_id string, observation_id string, result_id string, item_id string, identity_id string, identity_name string, identity_type string, method string, review_status string"


def research(spark, **changes):
    contexts = [("o1", "h1", "w1", "r1", "p", "en", "1", "q1", "g", "serp"), ("o2", "h2", "w1", "r2", "p", "en", "1", "a1", "c", "llm")]
    results = [("x1", "o1", "serp", "q1", "p", "g", "en", "1", "h1", "r1"), ("x2", "o2", "llm", "a1", "p", "c", "en", "1", "h2", "r2")]
    mappings = [("c1", "q1", "a1", True, "v1", dt.date(2026, 1, 1), None), ("c2", "q1", "zz", True, "v1", dt.date(2030, 1, 1), None), ("c3", "q1", "zz", False, "v1", dt.date(2026, 1, 1), None)]
    rows = {"contexts": contexts, "results": results, "mappings": mappings, "matches": [
        ("e1", "o1", "x1", "i1", "k1", "Acme", "brand_candidate", "m", "candidate"), ("e2", "o1", "x1", "i1", "n1", "Need", "category", "m", "approved"),
        ("e3", "o1", "x1", "i2", "n1", "Need", "category", "m", "approved")], "coverage": [("x1", "product", "complete"), ("x2", "product", "partial")]} | changes
    make = lambda name, schema: spark.createDataFrame(rows[name], schema)
    coverage = make("coverage", "result_id string, feature string, coverage_status string")
    comparisons = make("mappings", "comparison_id string, query_id string, prompt_id string, active boolean, mapping_version string, effective_start_date date, effective_end_date date")
    metrics = coverage.withColumn("share", F.lit(0.25))
    day = F.lit("2026-10-01").cast("date")
    return research_snapshot.snapshot("rel", make("contexts", CONTEXT), make("results", RESULT), metrics, coverage, make("matches", MATCH), comparisons, day)


def test_research_snapshot(spark, tmp_path):
    rows = research(spark).collect()
    assert Counter(r.kind for r in rows) == {"metrics": 2, "coverage": 2, "candidates": 1, "mappings": 1, "needs": 1, "pairs": 1}
    for r in rows:  # ids hash the payload as the source system would write it
        payload = json.dumps(json.loads(r.payload_json), sort_keys=True, ensure_ascii=False)
        assert payload == r.payload_json
        assert r.row_id == str(uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([r.kind, payload], ensure_ascii=False)))
    pair = json.loads(next(r.payload_json for r in rows if r.kind == "pairs"))
    assert pair["serp_result_id"] == "x1" and pair["llm_result_id"] == "x2" and pair["collection_window"] == "w1"


BASE = [("o1", "h1", "w1", "r1", "p", "en", "1", "q1", "g", "serp"), ("o2", "h2", "w1", "r2", "p", "en", "1", "a1", "c", "llm")]


@pytest.mark.parametrize("message, changes", [
    ("missing or ambiguous context", {"contexts": [*BASE, ("o1", "h1", "w2", "r1", "p", "en", "1", "q1", "g", "serp")]}),
    ("missing or ambiguous context", {"contexts": BASE[:1]}),
    ("response hash differs", {"contexts": [("o1", "zz", *BASE[0][2:]), BASE[1]]}),
    ("location_code differs", {"contexts": [(*BASE[0][:6], None, *BASE[0][7:]), BASE[1]]}),
    ("orphan research evidence", {"coverage": [("x1", "product", "complete"), ("gone", "product", "complete")]}),
    ("duplicate active research comparison", {"mappings": [("c1", "q1", "a1", True, "v1", dt.date(2026, 1, 1), None), ("c2", "q1", "a1", True, "v2", dt.date(2031, 1, 1), None)]}),
])
def test_a_research_snapshot_fails_closed(spark, tmp_path, message, changes):
    with pytest.raises(Exception, match=message):
        research(spark, **changes).write.parquet(str(tmp_path / "snapshot"))
    assert not os.path.exists(tmp_path / "snapshot" / "_SUCCESS")


def test_exports(spark, tmp_path):
    df = spark.range(5).withColumn("tags", F.array(F.lit("a")))
    assert sinks.export_relations({"t": df}, str(tmp_path / "x")).first()["rows"] == 5
    sinks.write_reports(df, str(tmp_path), "t")
    assert spark.read.option("header", "true").csv(str(tmp_path / "t_csv")).first()["tags"] == '["a"]'


def test_dense_grain_is_complete(spark):
    rows, registry = spark.range(100).withColumnRenamed("id", "k"), spark.range(7).withColumnRenamed("id", "b")
    assert dense_grain(rows, registry, "k").distinct().count() == 700


def test_running_sum_over_blocks(spark):
    df = spark.range(1000).selectExpr("'hot' as key", "id as position", "id % 7 as cents")
    got = {r.position: r.total for r in ledger.running_sum(df, ["key"], ["position"], "cents", "total").collect()}
    total = 0
    for n in range(1000):
        total += n % 7
        assert got[n] == total


def test_shared_dir_prefers_the_cluster_setting(tmp_path):
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: str(tmp_path)))
    assert shared_dir(session) == str(tmp_path)


def test_streaming_ingest(spark, tmp_path):
    root, target, checkpoint = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "cp")
    write_triple(root, "serp", "2026/09/28", "one")
    sink = ingest.insert_or_ignore_sink(target, ["sha256"], [F.asc("path")])

    def run():
        stream = raw.inventory(ingest.raw_stream(spark, root)).select("path", "sha256")
        ingest.start_once(stream, sink, checkpoint).awaitTermination()

    run()
    write_triple(root, "llm", "2026/09/28", "two")
    run()
    rows = spark.read.parquet(target)
    # The equal request and response of the second triple are known by checksum already.
    assert rows.count() == 4 and rows.select("sha256").distinct().count() == 4


def test_streaming_latest_slices_and_dedup(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "slices")
    schema = "slice string, at timestamp, id string"
    rows = spark.createDataFrame([("a", "2026-01-01 00:00:00", "1"), ("a", "2026-01-02 00:00:00", "2"), ("b", "2026-01-01 00:00:00", "3")], "slice string, at string, id string")
    rows.withColumn("at", F.to_timestamp("at")).write.parquet(f"{source}")
    stream = spark.readStream.schema(schema).parquet(source)
    sink = ingest.latest_slice_sink(target, ["slice"], "at", "id")
    ingest.start_once(stream, sink, str(tmp_path / "cp1")).awaitTermination()
    current = ingest.current_slices(spark, target, spark.read.schema(schema).parquet(source).schema)
    assert sorted(r.id for r in current.collect()) == ["2", "3"]
    deduped = ingest.deduplicated(stream.withColumn("key", F.col("slice")), ["key"], "at", "5 days")
    out = str(tmp_path / "dedup")
    deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_batches_read_a_flat_number_of_files(spark, tmp_path):
    sink = ingest.insert_or_ignore_sink(str(tmp_path / "rows"), ["k"], [F.asc("v")], buckets=4)
    seen, read = ingest.Buckets(str(tmp_path / "rows-keys"), ["k"], 4), []
    for n in range(20):
        batch = spark.range(40).select((F.col("id") + 20 * n).alias("k"), F.lit(n).alias("v"))
        read.append(len(seen.read(spark, batch.select("k").schema, None, n).inputFiles()))
        sink(batch, n)
        if n in (3, 4):
            sink(batch, n)  # a batch that runs again
    assert max(read) <= 4 and all(len(os.listdir(tmp_path / "rows-keys" / f"bucket={b}")) <= 2 for b in range(4))
    rows = spark.read.parquet(str(tmp_path / "rows")).select("k", "v").collect()
    assert len(rows) == 20 * 20 + 20 and all(r.v == max(0, r.k // 20 - 1) for r in rows)


def test_a_late_older_row_does_not_win(spark, tmp_path):
    sink, schema = ingest.latest_slice_sink(str(tmp_path / "s"), ["k"], "t", "id", buckets=3), "k string, t int, id string"
    batches = [[("a", 5, "1"), ("b", 1, "2"), ("c", None, "3")], [("a", 3, "4"), ("b", 2, "5"), ("c", None, "0"), ("d", 0, "6")], [("a", 5, "0"), ("c", 1, "7")]]
    for n, rows in enumerate(batches):
        for _ in range(1 + n % 2):
            sink(spark.createDataFrame(rows, schema), n)
    current = ingest.current_slices(spark, str(tmp_path / "s"), spark.createDataFrame([], schema).schema)
    assert {r.k: r.id for r in current.collect()} == {"a": "0", "b": "5", "c": "7", "d": "6"}


def test_latest_per_puts_unknown_times_last(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", 1, "c"), ("k", 1, "b")], "k string, t int, id string")
    assert latest_per(df, ["k"], "t", "id").first()["id"] == "b"


def test_sanitizing_reaches_any_depth(spark):
    deep, want = '{"password":"S","k":1}', '{"k":1}'
    for _ in range(12):
        deep, want = '{"a":[' + deep + '],"Token":{"x":[1,{"y":2}]}}', '{"a":[' + want + "]}"
    texts = [
        (deep, want),
        ('{"u":"http://h/?token=z","k":1}', '{"k":1,"u":"http://h/?token=[REDACTED]"}'),
        ('{"u":"http://h/?secret=a\\"b&x=1"}', '{"u":"http://h/?secret=[REDACTED]&x=1"}'),
        ('{"login":1}', "{}"),
        ('[1,{"secret":2,"z":3},{"api_key":[]}]', '[1,{"z":3},{}]'),
        ("see http://h/?token=z now", "see http://h/?token=[REDACTED] now"),
        (None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, payload string")
    got = {r.i: r.payload for r in payloads.sanitized(df, "payload").collect()}
    assert [got[i] for i in range(len(texts))] == [w for _, w in texts]


def test_trees_of_any_depth(spark):
    inner = '{"type":"x","references":[{"url":"http://a.b/c"}]}'
    for _ in range(20):
        inner = '{"type":"organic","images":[' + inner + "]}"
    rows = spark.createDataFrame([('{"items":[' + inner + "]}",)], "j string").selectExpr(
        "'o' as observation_id", "'r' as result_id", "'serp' as source_category", "'$' as json_path", "parse_json(j) as result"
    )
    found = tree.walk(rows, tree.FEATURE_GRAMMAR).groupBy("item_kind").agg(F.count("*"), F.max("depth")).collect()
    assert sorted(tuple(r) for r in found) == [("citation", 1, 21), ("image", 20, 20), ("organic", 1, 0)]


def test_brand_rules_differ_on_missing_names(spark):
    rows = spark.createDataFrame(
        [("a", None, "owned", "x", True), ("b", "B", "Owned", "example", True), ("c", "C", "competitor", "x", True), ("d", "Example", "owned", "x", True)],
        "brand_id string, canonical_name string, ownership_type string, market string, active boolean",
    )
    assert {r.brand_id for r in staging.eligible_brands(rows).collect()} == {"b", "c"}
    assert {r.brand_id for r in staging.eligible_brand_rows(rows).collect()} == {"a", "c"}


def test_manifest_problems(spark):
    manifest = '{"files": {"response.json": {"sha256": "x", "byte_size": 9}}}'
    rows = [("d", "metadata.json", manifest), ("d", "response.json", "{}"), ("d", "request.json", "{}"), ("n", "metadata.json", '{"run_id": 1}')]
    content = spark.createDataFrame([(f"/root/raw/serp/northwind/google/2026/09/28/run1/{d}/{n}", len(b), b.encode()) for d, n, b in rows], "path string, length long, content binary")
    found = {(r.directory[-1], r.file_name, r.result) for r in raw.verify_manifest(raw.inventory(content)).collect()}
    assert found == {
        ("d", "response.json", "size_mismatch"), ("d", "response.json", "checksum_mismatch"),
        ("d", "request.json", "missing_file"), ("n", None, "missing_manifest"),
    }


def test_repeated_sequence_numbers(spark):
    events = spark.createDataFrame(
        [("a", 1, "new"), ("a", 2, "in_review"), ("a", 2, "closed"), ("a", 3, "lost")], "opportunity_id string, sequence int, status string",
    ).selectExpr("*", "'r' as release_id", "'observation' as classification", "'u' as reviewer", "'x' as reason", "'y' as next_action")
    found = sorted((r.sequence, r.problem) for r in reviews.review_problems(events).collect())
    assert found == [(2, "invalid transition"), (2, "repeated sequence"), (3, "invalid transition"), (3, "unsupported status")]
