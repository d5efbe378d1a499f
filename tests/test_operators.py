"""Literal rows for operators that the queries cover only in bulk."""

import hashlib
import json

import pytest

from attestry.operators import assess, evaluate, replies, review, versions
from attestry.schemas import PAGES

REQUESTS = "request_id string, parsed_document_id string, page_numbers array<int>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [("d", "v", 1, "one"), ("d", "v", 2, "two two"), ("d", "v", 3, "  \n"), ("d", "v", 4, "x" * 50)]
    return spark.createDataFrame(rows, PAGES)


def test_page_choices_and_their_hash(spark, pages):
    asked = {
        "ok": [2, 1], "twice": [1, 1], "outside": [1, 9], "many": [1, 2, 4], "long": [2, 4], "blank": [3], "none": [],
    }
    requests = spark.createDataFrame([(k, "d", v) for k, v in asked.items()], REQUESTS)
    selected = replies.select_pages(requests, pages, max_pages=2, max_characters=20)
    assert {r.request_id: r.status for r in selected.collect()} == {
        "ok": "ok", "twice": "not_unique", "outside": "page_outside_document", "many": "page_budget_exceeded",
        "long": "character_budget_exceeded", "blank": "no_text", "none": "not_unique",
    }
    text = json.dumps([{"page_number": 1, "text": "one"}, {"page_number": 2, "text": "two two"}], separators=(",", ":"))
    (row,) = replies.selected_pages_hash(selected, requests, pages).collect()
    assert (row.request_id, row.selected_pages_hash) == ("ok", hashlib.sha256(text.encode()).hexdigest())
    with pytest.raises(ValueError):
        replies.select_pages(requests, pages, max_pages=0)


def test_only_open_requests_are_pending(spark):
    layout = "document_version_id string, selected_pages_hash string, requested_fields array<string>, model string, prompt_version string"
    requests = spark.createDataFrame([(v, "h", ["a"], "m", "1") for v in ("done", "failed", "new")], layout)
    completed = spark.createDataFrame(
        [("done", "h", ["a"], "m", "1", "succeeded"), ("failed", "h", ["a"], "m", "1", "failed"), ("new", "h", ["b"], "m", "1", "succeeded")],
        layout + ", status string",
    )
    got = {r.document_version_id for r in replies.pending_requests(requests, completed).collect()}
    assert got == {"failed", "new"}


VALUES = "run string, field_name string, value_json string, unit string, missing_reason string"


def test_value_sets_of_two_extractors(spark):
    fields = ("same", "more", "left", "right", "neither", "unit")
    asked = spark.createDataFrame([("r", f, None, None, None) for f in fields], VALUES)
    left = [("same", "1", None), ("same", "1", None), ("more", "1", None), ("more", "2", None), ("left", "1", None), ("unit", "1", "t")]
    right = [("same", "1", None), ("more", "1", None), ("right", "1", None), ("unit", "1", "kg")]
    frames = [spark.createDataFrame([("r", f, v, u, None) for f, v, u in x] + [("r", "neither", None, None, "not_found")], VALUES) for x in (left, right)]
    got = {r.field_name: (r.outcome, r.regex_conflict, r.llm_conflict) for r in evaluate.compare_extractors(asked, *frames, ["run"]).collect()}
    assert got == {
        "same": ("same_values", False, False), "more": ("different_values", True, False), "left": ("regex_only", False, False),
        "right": ("llm_only", False, False), "neither": ("both_missing", False, False), "unit": ("different_values", False, False),
    }
    counts = evaluate.comparison_counts(evaluate.compare_extractors(asked, *frames, ["run"]), ["run"]).first()
    assert (counts.both_missing, counts.llm_only, counts.regex_only, counts.same_values, counts.different_values) == (1, 1, 1, 1, 2)


def test_identities_of_a_report(spark):
    frame = spark.createDataFrame
    reports = frame([("r", "x", "d", "v", "verra", "p"), ("bad", "y", "d", "w", "acr", "q")],
                    "validation_run_id string, extraction_run_id string, parsed_document_id string, document_version_id string, registry string, project_id string")
    extractions = frame([("x", "d", "v", "verra", "p")], "extraction_run_id string, parsed_document_id string, document_version_id string, registry string, project_id string")
    runs = frame([("x", "baseline_extracted", "succeeded", "h"), ("r", "quality_validated", "succeeded", "h"), ("bad", "parsed", "failed", "g")],
                 "pipeline_run_id string, stage string, status string, input_hash string")
    parsed = frame([("d", "v", "h")], "parsed_document_id string, document_version_id string, input_hash string")
    stored = frame([("v", "s")], "document_version_id string, source_document_id string")
    sources = frame([("s", "verra", "p")], "source_document_id string, registry string, registry_project_id string")
    got = review.identity_violations(reports, extractions, runs, parsed, stored, sources).collect()
    rules = {r.rule for r in got}
    assert {r.validation_run_id for r in got} == {"bad"}
    assert {"extraction_absent", "extraction_run_absent", "source_absent", "parsed_version_differs", "validation_run_status",
            "validation_run_stage", "validation_input_hash"} <= rules
    assert not {"parsed_document_absent", "validation_run_absent"} & rules


def test_storage_keys_refuse_unsafe_parts(spark):
    rows = [("verra", "p", "pdd", "1.pdf", "h"), ("verra", "../p", "pdd", "1.pdf", "h"), ("verra", "a/b", "pdd", "1.pdf", "h"),
            ("verra", "", "pdd", "1.pdf", "h"), ("verra", None, "pdd", "1.pdf", "h")]
    made = spark.createDataFrame(rows, "registry string, project_id string, document_type string, document_version string, sha256 string")
    got = {r.project_id: (r.object_key, r.rule) for r in versions.object_keys(made).collect()}
    assert got == {"p": ("verra/p/pdd/1.pdf/h", None), **{x: (None, "unsafe_component") for x in ("../p", "a/b", "", None)}}


FACTS = "registry string, project_id string, field_name string, fact_id string, value_json string, unit string"


def test_readiness_goes_stale_when_a_fact_goes(spark):
    facts = spark.createDataFrame([("verra", "p", f, f"f-{f}", '"x"', None) for f in ("project_name", "technology_type")], FACTS)
    stored = assess.readiness(facts)
    assert assess.stale_readiness(stored, assess.readiness(facts)).isEmpty()
    stale = assess.stale_readiness(stored, assess.readiness(facts.where("field_name = 'project_name'"), facts.select("registry", "project_id").distinct()))
    assert [(r.dimension_id, r.rule) for r in stale.collect()] == [("D02", "stale_readiness")]


def test_judgments_need_known_criteria_facts_in_scope_and_real_quotes(spark, pages):
    evidence = "array<struct<document_version_id:string,page_number:int,quote:string,char_start:int,char_end:int>>"
    real, loose = ("v", 2, "two", 0, 3), ("v", 2, "ten", 0, 3)
    judged = spark.createDataFrame(
        [("ok", "verra", "p", "D02.C1", ["t"], [real]), ("unknown", "verra", "p", "D77.C1", ["t"], [real]),
         ("scope", "verra", "p", "D03.C1", ["t"], [real]), ("loose", "verra", "p", "D02.C1", ["t"], [loose]),
         ("other", "verra", "q", "D02.C1", ["t"], [])],
        f"request_id string, registry string, project_id string, criterion_id string, fact_ids array<string>, evidence {evidence}",
    )
    facts = spark.createDataFrame(
        [("verra", "p", "technology_type", "t", "d", "v")],
        "registry string, project_id string, field_name string, fact_id string, parsed_document_id string, document_version_id string",
    )
    got = {(r.request_id, r.rule) for r in assess.judgment_violations(judged, facts, pages).collect()}
    assert got == {
        ("unknown", "unknown_criterion"), ("scope", "fact_out_of_scope"), ("scope", "judgment_not_grounded"),
        ("loose", "judgment_not_grounded"), ("other", "fact_out_of_scope"),
    }


def test_facts_keep_their_origin_or_are_named(spark):
    frame = spark.createDataFrame
    heads = frame([("verra", "p", "country", "f"), ("verra", "p", "project_name", "g")], "registry string, project_id string, field_name string, fact_id string")
    facts = frame([("f", "df", '"Peru"', None), ("g", "dg", '"X"', None)], "fact_id string, decision_id string, value_json string, unit string")
    decisions = frame([("df", "c", "approved", '"Peru"', None), ("dg", "c2", "approved", '"Y"', None)],
                      "decision_id string, candidate_id string, status string, after_value_json string, unit string")
    candidates = frame([("c", "r", "country"), ("c2", "r", "project_name")], "candidate_id string, validation_run_id string, field_name string")
    reports = frame([("r", "x", "d", "verra", "p")], "validation_run_id string, extraction_run_id string, parsed_document_id string, registry string, project_id string")
    parsed = frame([("d", "v")], "parsed_document_id string, document_version_id string")
    stored = frame([("v", "s", "sha")], "document_version_id string, source_document_id string, sha256 string")
    sources = frame([("s", "https://example.org")], "source_document_id string, source_url string")
    chain, broken = assess.provenance(heads, facts, decisions, candidates, reports, parsed, stored, sources)
    assert [(r.fact_id, r.extraction_run_id, r.sha256, r.source_url) for r in chain.collect()] == [("f", "x", "sha", "https://example.org")]
    assert [(r.fact_id, r.rule) for r in broken.collect()] == [("g", "canonical_provenance_mismatch")]
