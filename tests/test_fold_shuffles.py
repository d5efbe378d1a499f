"""Outcomes meet the chain in one shuffle, keyed by sixteen bytes instead of names."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_outcomes_are_joined_to_the_chain_in_one_shuffle(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    out = io.StringIO()
    try:
        with contextlib.redirect_stdout(out):
            queries()["decision_outcomes"](spark, FOLDER).explain()
    finally:
        spark.conf.set(threshold, kept)
    dealt = re.findall(r"Exchange hashpartitioning\((\S+?)#", out.getvalue())
    assert dealt and set(dealt) == {"expected"}


@pytest.mark.parametrize("name", ["decision_outcomes", "canonical_facts", "canonical_heads", "decision_replays"])
def test_results_equal_the_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == []
