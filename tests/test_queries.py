"""A fast sample of the registered queries against their SQL; the checker runs all of them."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from attestry.plans.oracles import ORACLES
from attestry.plans.queries import QUERIES
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "keyword_totals", "text_quality", "ocr_merge", "ingest_new_versions", "version_history",
    "reprocess_gate", "evidence_grounding", "review_queue", "review_metrics", "readiness",
    "business_gates", "er_diagnostic", "gold_aggregate", "html_links", "contract_pages",
)


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    assert compare(queries()[name](spark, FOLDER), db, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
