"""Pages that were dealt by their key before their text was formed are stored without moving again."""

import pytest

from __spark_entry__ import oracle_sql, queries
from attestry.sources.parsed import PAGE_KEY, ParsedStore
from oracle import compare, connect

DOCUMENTS = "parsed_document_id string, document_version_id string, configuration_hash string"
PAGES = "parsed_document_id string, page_number int, text string"


def test_a_dealt_write_stores_the_same_pages(spark, tmp_path):
    documents = spark.createDataFrame([("a", "va", "h"), ("b", "va", "h"), ("c", "vc", "h")], DOCUMENTS)
    rows = [(d, n, f"{d}{n}") for d in "abcx" for n in (1, 2, 2, None)]
    pages = spark.createDataFrame(rows, PAGES)
    held = []
    for dealt in (False, True):
        store = ParsedStore(spark, str(tmp_path / f"parsed-{dealt}"), documents.schema, pages.schema, buckets=4)
        given = pages.repartition(4, *PAGE_KEY) if dealt else pages
        reused = store.write(documents, given, dealt=dealt)
        held.append((store.pages().collect(), reused.collect()))
        store.drop()
    plain, dealt = ([sorted(map(str, part)) for part in parts] for parts in held)
    assert plain == dealt and len(plain[0]) == 8


@pytest.mark.parametrize("name", ["stored_grounding", "stored_page_counts"])
def test_results_equal_the_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(queries()[name](spark, folder), connect(folder), oracle_sql()[name]) == []
