import pytest

from attestry.functions.text import WHITESPACE
from attestry.operators.keywords import keyword_evidence, keyword_scores, keyword_totals
from attestry.operators.pages import merge_ocr_text, page_sequence, route_ocr, text_quality
from attestry.schemas import PAGES

DENIAL = "Not grid-connected. Project boundary undefined; applicability not established."


def d01(spark, *texts):
    pages = spark.createDataFrame([("d", "v", n, t) for n, t in enumerate(texts, 1)], PAGES)
    return keyword_scores(pages).where("dimension_id = 'D01'").first()


@pytest.mark.parametrize(
    "text,score",
    [
        ("", 0),
        ("scope", 1),
        ("GRID-CONNECTED", 2),
        ("grid-connected project boundary applicability", 3),
    ],
)
def test_keyword_ladder(spark, text, score):
    assert d01(spark, text).score == score


def test_negation_counts_and_pages_do_not_join(spark):
    assert (d01(spark, DENIAL).score, d01(spark, DENIAL * 4).hit_count_high) == (3, 3)
    assert d01(spark, "project", "boundary").hit_count_high == 0


def test_evidence_comes_from_the_first_document_of_a_scope(spark):
    rows = [
        ("s", 1, "one", 1, "unrelated"), ("s", 1, "one", 2, DENIAL), ("s", 2, "two", 1, DENIAL),
    ]
    pages = spark.createDataFrame(
        rows, "scope string, document int, document_version_id string, page_number int, text string"
    )
    found = keyword_evidence(pages, ["scope"], page_order=("document", "page_number")).where(
        "dimension_id = 'D01'"
    ).collect()
    assert len(found) == 3
    for row in found:
        assert (row.document_version_id, row.page_number) == ("one", 2)
        assert DENIAL[row.char_start : row.char_end] == row.quote
    totals = keyword_totals(pages, ["scope"]).first()
    assert totals.keyword_score_ratio == totals.total_score / 36


def test_words_and_case_variants(spark):
    pages = spark.createDataFrame(
        [("d", "v", 1, "the PE. cape lé"), ("e", "v", 1, "WİND ſcope")], PAGES
    )
    scores = {
        (r.parsed_document_id, r.dimension_id): r.hit_count_high + r.hit_count_mid
        for r in keyword_scores(pages).collect()
    }
    assert scores[("d", "D06")] == 1
    assert scores[("e", "D02")] == 1 and scores[("e", "D01")] == 1


def routed(spark, text, ink=None):
    page = spark.createDataFrame(
        [("d", "v", 1, text, ink)], PAGES + ", ink_ratio double"
    )
    return route_ocr(text_quality(page)).first()


def test_routing_boundaries(spark):
    assert routed(spark, "x" * 79).route == "ocr_required"
    assert routed(spark, "x" * 80).route == "native"
    assert routed(spark, "x" * 98 + "�" * 2).route == "native"
    assert routed(spark, "x" * 979 + "�" * 21).route == "ocr_required"
    blank = routed(spark, "", 0.0)
    assert (blank.route, blank.warning) == ("blank", "page 1: blank page skipped OCR")
    assert routed(spark, "", 0.5).route == "ocr_required"
    with pytest.raises(ValueError):
        route_ocr(spark.createDataFrame([], PAGES), min_non_whitespace=-1)


def test_quality_counts_every_kind_of_space(spark):
    text = "aé9" + WHITESPACE + "_�"
    row = text_quality(spark.createDataFrame([("d", "v", 1, text)], PAGES)).first()
    assert row.character_count == len(text)
    assert row.non_whitespace_count == 5
    assert row.alphanumeric_ratio == 3 / 5
    assert row.replacement_character_ratio == 1 / len(text)


def test_recognised_text_replaces_routed_pages_only(spark):
    pages = spark.createDataFrame(
        [("d", "v", 1, "x" * 90, None), ("d", "v", 2, "y", None), ("d", "v", 3, "z", 0.0)],
        PAGES + ", ink_ratio double",
    )
    recognised = spark.createDataFrame(
        [("d", n, "scan") for n in (1, 2, 3)],
        "parsed_document_id string, page_number int, ocr_text string",
    )
    rows = merge_ocr_text(route_ocr(text_quality(pages)), recognised).orderBy("page_number").collect()
    assert [(r.text[:4], r.used_ocr) for r in rows] == [
        ("xxxx", False), ("scan", True), ("z", False),
    ]
    assert rows[1].character_count == 4


def test_page_sequence(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", 1), ("c", 1)]
    pages = spark.createDataFrame(rows, "parsed_document_id string, page_number int")
    got = {r.parsed_document_id: r.sequential for r in page_sequence(pages).collect()}
    assert got == {"a": True, "b": False, "c": False}
