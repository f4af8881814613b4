"""A spread of registered queries against their checking SQL on the smallest data."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from sightline.plans.bindings import TABLES

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "staged_requests", "eligible_brands", "serp_brand_visibility", "answer_brand_visibility",
    "answer_brand_visibility_by_ngram_join", "comparison_brand_metrics", "presence_summary",
    "opportunity_patterns", "serp_quarantine", "feature_coverage", "brand_text_matches",
    "research_metrics", "term_spans", "category_rule_matches", "response_brand_evidence", "response_category_evidence", "response_items",
    "response_summaries", "summary_invariants", "triple_integrity", "review_log_problems", "spend_ledger", "release_assessment",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def counted(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(plain(r[n]) for n in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert counted([tuple(r) for r in df.collect()], df.columns) == counted(rel.fetchall(), rel.columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_presence_matrix_has_every_brand(spark):
    assert set(entry.queries()["presence_matrix"](spark, FOLDER).columns) == {"scope", "locale", *(f"brand{n}" for n in range(1, 26))}
