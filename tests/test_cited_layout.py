"""Cited quotes are spread over all tasks, those without a document too."""

import contextlib
import io
import re

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_quotes_and_documents_are_dealt_into_all_tasks(spark):
    frame = queries()["judgment_violations"](spark, FOLDER)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    dealt = re.findall(r"Exchange hashpartitioning\((.*)\), REPARTITION_BY_NUM", out.getvalue())
    assert len([keys for keys in dealt if "document_version_id" in keys]) == 2  # quotes and documents
    assert len(dealt) == 3  # and what grounding found, per judgment
    assert compare(frame, connect(FOLDER), oracle_sql()["judgment_violations"]) == []
