"""Queries on tables whose keys are as large as those of sixty copies."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Part keys of a sixtieth copy: page numbers pass 32 bits. Each line once, as it names a request."""
    out = tmp_path_factory.mktemp("large")
    for name in os.listdir(SOURCE):
        if name != "lineitem.parquet":
            os.symlink(f"{SOURCE}/{name}", out / name)
    connect(SOURCE).execute(
        "COPY (SELECT * REPLACE (l_partkey + 1200000 AS l_partkey) FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1) "
        f"TO '{out}/lineitem.parquet'"
    )
    return str(out)


@pytest.mark.parametrize("name", ["reply_violations", "reply_observations"])
def test_query_equals_sql_with_large_page_numbers(spark, folder, name):
    assert compare(queries()[name](spark, folder), connect(folder), oracle_sql()[name]) == []
