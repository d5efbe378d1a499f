"""Evidence of a stored model result is formed once, not again in a filter before it is exploded."""

import contextlib
import io
import re

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


def test_evidence_is_exploded_without_a_filter_of_its_own(spark):
    frame = queries()["comparison_refusals"](spark, FOLDER)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    assert set(re.findall(r"Generate explode\(evidence[^)]*\), \[[^\]]*\], (\w+)", out.getvalue())) == {"true"}
