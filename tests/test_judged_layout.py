"""Judgments of a request stay in the task that its lines were dealt to."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_judgments_are_not_shuffled_after_they_are_formed(spark):
    frame = queries()["contract_judgments"](spark, FOLDER)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", out.getvalue())
    # A group by request and criterion, formed from the lines, would be dealt by both.
    assert dealt and not [keys for keys in dealt if "_groupingexpression" in keys]


@pytest.mark.parametrize("name", ["contract_judgments", "contract_evaluations", "rubric_coverage"])
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == []


def test_coverage_of_requests_needs_no_exchange_by_request_alone(spark):
    frame = queries()["contract_evaluations"](spark, FOLDER)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    assert "REPARTITION_BY_NUM" in out.getvalue()
