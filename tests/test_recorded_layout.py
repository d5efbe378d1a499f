"""The recorded views: methods that the JVM compiles, page text that is not shuffled."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from attestry.operators import grounding
from attestry.plans.queries import validated
from attestry.sources import adapters
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"


def shown(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def method_sizes(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown(df, "codegen"))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_validation_methods_are_compiled(spark):
    assert max(method_sizes(spark, adapters.observations(spark, FOLDER))) <= 8000
    assert max(method_sizes(spark, validated(spark, FOLDER).drop("validation_issues"))) <= 8000


def test_keyed_pages_are_the_same_pages(spark):
    columns = ["parsed_document_id", "document_version_id", "page_number", "text"]
    one, other = (f(spark, FOLDER).select(*columns) for f in (adapters.carbon_pages, adapters.keyed_pages))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_text_is_not_shuffled(spark):
    quotes = spark.range(3).select(
        F.concat(F.lit("D"), "id").alias("parsed_document_id"), "id", F.col("id").alias("page_number"), F.lit("x").alias("quote"),
        F.lit(0).alias("char_start"), F.lit(1).alias("char_end"),
    )
    plan = shown(grounding.ground(quotes.hint("merge"), adapters.keyed_pages(spark, FOLDER)), "simple")
    assert plan.count("Exchange hashpartitioning") == 2  # the quotes, and the lines before they are text


@pytest.mark.parametrize("name", ["candidate_validation", "replacement_verdicts", "contract_validation"])
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == []
