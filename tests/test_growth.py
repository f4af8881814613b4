"""Plans and results of steps whose work must grow with the input, not with its square or with the driver."""

import os

import pytest

from sightline.operators import evidence
from sightline.plans import evidence_queries as eq
from sightline.plans.bindings import Inputs
from sightline.session import configure

FOLDER = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_keys_of_results_are_not_broadcast(spark, monkeypatch):
    i = Inputs(configure(spark), FOLDER)
    results, nodes, items, issues = eq.results(i), eq.nodes(i), eq.tree_items(i), eq.issues(i)
    # The fallback stores what it expands, so its join is looked at before that.
    monkeypatch.setattr(evidence.tree, "expand", lambda rows, start, grammar: rows)
    frames = [
        issues, evidence.feature_coverage(results, items, issues), evidence.result_context(results, items, issues),
        evidence.fallback_nodes(results, nodes), eq.dated(items, i),
    ]
    assert all("Broadcast" not in plan(df) for df in frames)
    assert "LeftAnti" in plan(frames[3])


@needs_tables
def test_presence_does_not_sort_or_shuffle_dense_rows(spark):
    import __spark_entry__ as entry

    shown = plan(entry.queries()["presence_summary"](spark, FOLDER))
    assert "Window" not in shown
    for name in ("source_statuses", "organic_share_rows"):
        assert "Window" not in plan(entry.queries()[name](spark, FOLDER))


@needs_tables
def test_latest_slices_are_chosen_before_brands(spark):
    """Search slices of every brand from the latest observations, equal to those chosen among all dense rows."""
    from sightline.operators import comparison
    from sightline.plans import visibility_queries as vq

    i = Inputs(configure(spark), FOLDER)
    columns = ["metric_id", "query_id", "brand_id", "observation_id", "availability_status", "numerator", "denominator", "best_normalized_rank", "collected_at"]
    few = vq.latest_serp_gold(i)
    whole = comparison.latest_slices(vq.serp_gold(i), comparison.SERP_SLICE)
    assert few.count() == whole.count() < vq.serp_gold(i).count()
    assert few.select(*columns).exceptAll(whole.select(*columns)).isEmpty()


def test_runs_of_texts_are_not_broadcast(spark):
    from sightline.operators.terms import attach_substrings

    rows = spark.createDataFrame([("a", "one brand"), ("b", "none")], "id string, text string")
    terms = spark.createDataFrame([("b1", "brand")], "identity string, needle string")
    found = attach_substrings(rows, "id", {"hits": (["text"], terms)})
    assert {r.id: r.hits for r in found.collect()} == {"a": ["b1"], "b": []}
    joins = [line for line in plan(found).splitlines() if "Join" in line and "gram" in line and "LeftOuter" not in line]
    assert any("SortMergeJoin" in line for line in joins)


def test_texts_are_dealt_out_before_they_are_folded_and_searched(spark):
    """A long text with a term at every other word: one search per term, in a task of its own and not in the scan's."""
    from sightline.operators.terms import match_spans, term_table

    n = 50_000
    rows = spark.createDataFrame([(1, "Straße and " * n), (2, "candy")], "key int, text string")
    terms = term_table(spark.createDataFrame([("b", "AND")], "id string, t string"), "id", "t")
    found = match_spans(rows, ["key"], "text", terms, suppress=False)
    shown = plan(found)
    assert "REPARTITION_BY_COL" in shown and "MapInArrow" in shown
    spans = [(r.key, r.span_start, r.span_end, r.matched_text) for r in found.collect()]
    assert sorted(spans) == [(1, 11 * i + 7, 11 * i + 10, "and") for i in range(n)]


def test_occurrences_are_taken_left_to_right_before_boundaries():
    from sightline.functions.text import spans_of

    term = {"identity": "x", "needle": "a a", "cjk": False}
    assert spans_of("xa a a", "xa a a", [], [term]) == []
    assert spans_of("A a a a", "a a a a", [], [term]) == [("x", 0, 3, "A a"), ("x", 4, 7, "a a")]
    assert spans_of("ß é", "ss é", [1], [{"identity": "y", "needle": "é", "cjk": False}]) == [("y", 2, 3, "é")]


@needs_tables
def test_raw_files_are_shuffled_once(spark):
    """One window by directory instead of joins of the files with themselves; the payloads are built once for the manifest too."""
    from sightline.plans import ledger_queries as lq
    from sightline.sources import raw

    found = raw.dispositions(lq.files(Inputs(configure(spark), FOLDER)))
    assert "Join" not in plan(found) and plan(found).count("hashpartitioning(directory") == 1
    known = found.filter("role = 'response'").select("request_id", "sha256")
    rows = raw.with_provenance(found, known)
    assert rows.filter("exact_provenance is not null").count() == found.filter(f"disposition = '{raw.CANDIDATE}'").count() > 0
    assert rows.count() == found.count() and rows.filter("not exact_provenance").isEmpty()


def test_verdicts_on_odd_metadata(spark):
    import hashlib
    import json

    from sightline.sources import raw

    body = b'{"a": 1}'
    digest = hashlib.sha256(body).hexdigest()

    def meta(sha, **more):
        files = {f"{r}.json": {"sha256": sha, "byte_size": len(body), "content_type": "t"} for r in raw.MANIFEST_ROLES}
        return {"request_id": "r", "run_id": "u", "provider": "p", "platform_or_engine": "e", "collected_at": "2026-09-28T10:00:00Z", "source_category": "serp", "files": files} | more

    cases = {
        "good": (meta(digest), []), "upper": (meta(digest.upper()), ["checksum mismatch for request.json", "checksum mismatch for response.json"]),
        "line": (meta(digest + "\n"), ["checksum mismatch for request.json", "checksum mismatch for response.json"]),
        "number": (meta(digest, request_id=7), ["missing metadata request_id"]),
        "files": (meta(digest, files=[1]), ["metadata has no file manifest", "missing file manifest request.json", "missing file manifest response.json"]),
        "stamp": (meta(digest, collected_at="2026-09-28T10:00:00"), ["collected_at is not timezone aware"]),
        "list": ([1], sorted(["non-object metadata.json", "missing file manifest request.json", "missing file manifest response.json", "source_category/path mismatch", *raw.WITHOUT_METADATA])),
    }
    rows = []
    for name, (metadata, _) in cases.items():
        for file, content in (("metadata.json", json.dumps(metadata).encode()), ("request.json", body), ("response.json", b" " + body if name == "size" else body)):
            rows.append((f"/x/serp/p/e/2026/09/28/run/{name}/{file}", len(content), content))
    rows += [("/x/serp/p/e/2026/09/28/run/short.json", 2, b"{}"), ("/x/serp/p/e/2026/9/28/run/rq/a.json", 2, b"{}")]
    files = raw.inventory(spark.createDataFrame(rows, "path string, length long, content binary"))
    assert files.count() == 3 * len(cases)
    for frame in (raw.triple_integrity(files), raw.dispositions(files)):
        got = {r.directory.rsplit("/", 1)[1]: r.integrity_problems for r in frame.collect()}
        assert got == {name: problems for name, (_, problems) in cases.items()}
    texts = {r.sha256 for r in raw.dispositions(files).collect() if r.role == "request"}
    assert texts == {digest}


def test_changed_files_of_any_checksum_text(spark):
    from sightline.sources import raw

    def rows(*pairs):
        return spark.createDataFrame(pairs, "path string, sha256 string")

    one, other = "ab" * 32, "AB" * 32
    before = rows(("a", one), ("b", one), ("c", None), ("d", "x"), ("e", one), ("f", "\x00" * 32))
    after = rows(("a", one), ("b", other), ("c", None), ("d", "y"), ("g", one), ("f", "\x00" * 31))
    checks = {r.check_name: r.value for r in raw.accounting({"undecided": 0, "responses": 0}, before, after).collect()}
    assert checks["raw_files_changed"] == 5
