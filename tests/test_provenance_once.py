"""The rows that facts, heads, decisions and candidates are taken from are formed once."""

import contextlib
import io

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def shown(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["fact_provenance", "provenance_violations"])
def test_facts_are_formed_once(spark, name):
    frame = queries()[name](spark, FOLDER)
    assert "l_partkey" not in shown(frame)
    assert compare(frame, connect(FOLDER), oracle_sql()[name]) == []
