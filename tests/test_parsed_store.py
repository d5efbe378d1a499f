"""Parsed pages: broken writes, repeated writes, and joins that leave page text where it is."""

import re

import pytest
from pyspark.sql import Row

from attestry.operators import grounding, pages
from attestry.sources.parsed import ParsedStore

DOCUMENTS = "parsed_document_id string, document_version_id string, configuration_hash string"
PAGES = "parsed_document_id string, page_number int, text string"
EVIDENCE = "parsed_document_id string, page_number int, quote string, char_start int, char_end int"


@pytest.fixture()
def store(spark, tmp_path):
    schemas = [spark.createDataFrame([], x).schema for x in (DOCUMENTS, PAGES)]
    made = ParsedStore(spark, str(tmp_path / "parsed"), *schemas, buckets=4)
    yield made
    made.drop()


def parse(spark, *ids, version="v"):
    documents = spark.createDataFrame([(i, f"{version}{i}", "h") for i in ids], DOCUMENTS)
    rows = spark.createDataFrame([(i, n, f"text {n} of {i}") for i in ids for n in range(1, 6)], PAGES)
    return documents, rows


def held(store):
    return sorted((r.parsed_document_id, r.page_number) for r in store.pages().collect())


def test_a_killed_write_leaves_no_page_twice(spark, store, monkeypatch):
    assert held(store) == []
    documents, rows = parse(spark, "a", "b")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_write_documents", die)
        with pytest.raises(RuntimeError):
            store.write(documents, rows)
    assert held(store) == [] and store.documents().isEmpty()
    store.write(documents, rows)
    assert held(store) == [(i, n) for i in "ab" for n in range(1, 6)]
    assert spark.table(store.name).count() == 20
    store.vacuum()
    assert spark.table(store.name).count() == 10
    assert held(store) == [(i, n) for i in "ab" for n in range(1, 6)]


def test_known_settings_are_reused(spark, store):
    store.write(*parse(spark, "a"))
    again, rows = parse(spark, "a", "c")
    renamed = again.replace({"a": "a2"}, subset=["parsed_document_id"])
    reused = store.write(renamed, rows.replace({"a": "a2"}, subset=["parsed_document_id"])).collect()
    assert [(r.parsed_document_id, r.stored_parsed_document_id) for r in reused] == [("a2", "a")]
    assert held(store) == [(i, n) for i in "ac" for n in range(1, 6)]
    assert sorted(r.parsed_document_id for r in store.documents().collect()) == ["a", "c"]


def test_grounding_moves_no_page_text(spark, store):
    store.write(*parse(spark, "a", "b", "c"))
    store.write(*parse(spark, "d", version="w"))
    quotes = spark.createDataFrame(
        [("a", 1, "text 1", 0, 6), ("d", 5, "of d", 7, 11), ("b", 2, "text", 1, 5), ("b", 9, "x", 0, 1), ("c", 3, "no", 0, 2)],
        EVIDENCE,
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grounded = grounding.ground(quotes, store.pages())
        got = sorted((r.parsed_document_id, r.page_number, r.outcome) for r in grounded.collect())
        plan = grounded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == [
        ("a", 1, "grounded"), ("b", 2, "offsets_mismatch"), ("b", 9, "page_missing"), ("c", 3, "quote_missing"), ("d", 5, "grounded"),
    ]
    final = plan.split("== Initial Plan ==")[0]
    depth = {m[2]: len(m[1]) for m in re.finditer(r"^([ :+\-*()\d]*)(Exchange hashpartitioning|FileScan parquet|SortMergeJoin)", final, re.M)}
    assert "Bucketed: true" in final and final.count("Exchange") == 1
    assert depth["FileScan parquet"] and final.index("Exchange") < final.index("FileScan")


def test_stored_pages_keep_sequence_and_header(spark, store):
    store.write(*parse(spark, "a", "b"))
    assert {r.sequential for r in pages.page_sequence(store.pages()).collect()} == {True}
    joined = pages.read_parsed(store.documents(), store.pages(), spark.createDataFrame([Row(parsed_document_id="b")]))
    assert sorted((r.document_version_id, r.page_number) for r in joined.collect()) == [("vb", n) for n in range(1, 6)]
