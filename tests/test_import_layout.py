"""Validation and import: observations move as little as they can, with the results of the plain joins."""

import contextlib
import io
import itertools
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from attestry.functions.values import canonical_hash
from attestry.operators import review, validate
from attestry.plans import lineage_queries
from attestry.plans.queries import validated
from attestry.sources import adapters
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"
ROW = "extraction_run_id string, validation_run_id string, observation_index int, unit string"


def plan_of(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = io.StringIO()
    try:
        with contextlib.redirect_stdout(out):
            df().explain("simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return out.getvalue()


def test_observations_stay_in_their_buckets(spark):
    plan = plan_of(spark, lambda: validated(spark, FOLDER))
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+L?, (\w+)#\d+L?\], .*LeftOuter", plan)
    assert joins.count(("extraction_run_id", "observation_index")) == 2
    assert ("extraction_run_id", "field_name") not in joins
    for line in plan.splitlines():
        assert not ("Exchange" in line and "value_json" in line)


def full(spark, rows):
    extra = {"field_name": "f", "raw_value": "r", "value_json": "1", "missing_reason": None}
    made = spark.createDataFrame(rows, ROW)
    return made.withColumns({
        **{k: F.lit(v).cast("string") for k, v in extra.items()}, "confidence": F.lit(0.5),
        "issues": F.array().cast("array<string>"), "evidence": F.array().cast("array<string>"),
    })


def by_full_outer_join(checks, observations):
    hashed = canonical_hash(*review.OBSERVATION_IDENTITY)
    mine = checks.select("extraction_run_id", "observation_index", "validation_run_id", hashed.alias("a"))
    theirs = observations.select("extraction_run_id", "observation_index", hashed.alias("b"))
    expected = theirs.join(mine.select("extraction_run_id", "validation_run_id").distinct(), "extraction_run_id")
    both = mine.join(expected, ["extraction_run_id", "validation_run_id", "observation_index"], "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("validation_run_id").distinct()


CASES = (
    ([1, 2], [1, 2]), ([1], [1, 2]), ([1, 2], [1]), ([1, 1], [1]), ([1], [1, 1]), ([None], [1]), ([1], [1, None]), ([None], [None]),
)


def test_mismatches_equal_a_full_outer_join(spark):
    checks, observations = [], []
    for n, ((a, b), unit) in enumerate(itertools.product(CASES, ("same", "other"))):
        run = f"X{n}"
        checks += [(run, f"R{n}", i, "same") for i in a] + [(run, f"second R{n}", 1, "same"), (run, f"second R{n}", 2, "same")]
        observations += [(run, None, i, unit if k else "same") for k, i in enumerate(b)]
    checks += [("lost", "no extraction", 1, "u"), (None, "no run", 1, "u"), ("X0", None, 1, "same")]
    observations += [("unread", None, 1, "u"), (None, None, 1, "u")]
    mine, theirs = full(spark, checks), full(spark, observations)
    got = review.observation_violations(mine, theirs)
    assert {r.rule for r in got.collect()} == {"observations_differ"}
    wanted = by_full_outer_join(mine, theirs).collect()
    assert sorted(str(r.validation_run_id) for r in got.collect()) == sorted(str(r.validation_run_id) for r in wanted)
    assert 5 < len(wanted) < 2 * len(CASES) * 2


def test_keyed_observations_are_the_same_observations(spark):
    one, other = adapters.observations(spark, FOLDER), adapters.keyed_observations(spark, FOLDER)
    other = other.select(one.columns)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.mark.parametrize("name", ["import_violations", "imported_candidates", "imported_evidence", "observation_mismatches"])
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == []


def test_chain_keeps_its_observations_where_they_are_checked(spark, monkeypatch):
    written, write = [], lineage_queries.materialize_buckets

    class Enough(Exception):
        pass

    def noted(df, keys, dealt=False):
        written.append((tuple(keys), dealt))
        if len(written) == 2:
            raise Enough
        return write(df, keys, dealt)

    monkeypatch.setattr(lineage_queries, "materialize_buckets", noted)
    with pytest.raises(Enough):
        lineage_queries.end_to_end_facts(spark, "/root/testdata/sf0.001")
    assert written == [(validate.KEY, False), (validate.KEY, True)]
