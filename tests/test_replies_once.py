"""Stored replies are parsed once, whatever is derived from them."""

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


def test_results_of_replies_do_not_parse_bodies_again(spark):
    for name in ("reply_observations", "reply_violations"):
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "body" not in plan
