"""Rule sets as tables, foreign extractors, refusals, import digests, manifests with broken lines."""

import json

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from attestry.catalog import Rule
from attestry.operators import assess, evaluate, external, extract, review, rules
from attestry.schemas import OBSERVATIONS, PAGES
from attestry.sources import manifest
from oracle import compare, connect

TEXT = "Project owner: Wind Ltd\nHost country: Peru\nInstalled capacity: 12 MW\n"


def pages(spark, *rows):
    return spark.createDataFrame(rows, PAGES)


def one(spark, text=TEXT):
    return pages(spark, ("d", "v", 1, text), ("d", "v", 2, "nothing to see"), ("e", "v", 1, None))


OWN = extract.RuleSet(
    (Rule("owner", r"owner:\s*", r"[^\n]+", "", "company", guard=("owner",)), Rule("power", r"", r"\d+", r"\s*MW", "integer", "MW", guard=("mw",))),
    ("owner", "power", "remark"),
)


def test_rule_sets_run_side_by_side_and_number_their_own_observations(spark):
    sets = rules.read_rule_sets(rules.rule_table(spark, {"own": OWN, "catalog": extract.RuleSet()}))
    assert sets["own"] == OWN and sets["catalog"].fields == extract.RuleSet().fields
    assert set(sets["catalog"].rules) == set(extract.RuleSet().rules)
    got = extract.extract_rule_sets(one(spark), sets).where("parsed_document_id = 'd'").collect()
    own = sorted((r.observation_index, r.field_name, r.value_json, r.missing_reason) for r in got if r.rule_set == "own")
    assert own == [
        (0, "owner", '"Wind Ltd"', None), (1, "power", "12", None), (2, "remark", None, "unsupported_by_baseline"),
    ]
    alone = extract.extract_regex(one(spark)).where("parsed_document_id = 'd'").collect()
    both = [r for r in got if r.rule_set == "catalog"]
    key = lambda r: (r.observation_index, r.field_name, r.raw_value, r.char_start)
    assert sorted(map(key, alone), key=str) == sorted(map(key, both), key=str)
    assert sorted(r.observation_index for r in both) == list(range(len(both)))


def test_pages_without_a_guard_send_no_text(spark):
    plan = extract.extract_matches(one(spark))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "RLIKE" in below and "Filter" in below
    assert extract._possible([Rule("x", "", "a+", "", "text")]) is None


def test_rule_tables_are_checked(spark):
    rows = rules.rule_table(spark, {"own": OWN}).collect()
    base = rows[0].asDict()
    bad = [
        {**base, "value": "(", "pattern_position": 1}, {**base, "value": "(a)(b)", "pattern_position": 2},
        {**base, "value": "a*", "prefix": "", "pattern_position": 3}, {**base, "kind": "colour", "pattern_position": 4, "value": "x1"},
        {**base, "guards": ["Owner"], "pattern_position": 5, "value": "x2"}, {**base, "pattern_position": 6},
        {**base, "pattern_position": 0, "value": "x3"}, {**base, "field_name": "other", "pattern_position": 0},
        {**base, "field_position": 9, "pattern_position": 7, "value": "x4"},
    ]
    table = spark.createDataFrame([*rows, *[Row(**x) for x in bad]], rules.RULES)
    got = {r.rule for r in rules.rule_violations(table).collect()}
    assert got == {
        "pattern_invalid", "pattern_needs_one_group", "pattern_matches_nothing_too", "kind_unknown", "guard_not_folded",
        "pattern_repeated", "pattern_position_repeated", "position_has_two_fields", "field_has_two_positions",
    }
    with pytest.raises(ValueError, match="pattern_invalid"):
        rules.read_rule_sets(table)


def test_wrong_guards_are_found(spark):
    wrong = extract.RuleSet((Rule("power", "", r"\d+", r"\s*MW", "integer", guard=("gw",)),), ("power",))
    got = rules.unguarded_matches(one(spark), {"w": wrong, "own": OWN}).collect()
    assert [(r.parsed_document_id, r.page_number, r.rule_set, r.field_name) for r in got] == [("d", 1, "w", "power")]


def test_page_choices_are_refused_by_document(spark):
    chosen = spark.createDataFrame([("d", 1), ("d", 1), ("e", 1), ("e", 7)], "parsed_document_id string, page_number int")
    got = {(r.parsed_document_id, r.page_number, r.rule) for r in extract.page_subset_refusals(one(spark), chosen).collect()}
    assert got == {("d", 1, "page_repeated"), ("e", 7, "page_unknown")}
    assert extract.extract_regex(one(spark), page_subset=chosen).isEmpty()
    fine = chosen.where("parsed_document_id = 'd'").distinct()
    assert {r.parsed_document_id for r in extract.extract_regex(one(spark), page_subset=fine).collect()} == {"d"}


HEADERS = "registry string, project_id string, document_version_id string, parsed_document_id string, extraction_run_id string"


def observation(document, index, quote="Peru", start=38, **more):
    evidence = {"document_version_id": "v", "page_number": 1, "quote": quote, "char_start": start, "char_end": start + len(quote)}
    return {
        "parsed_document_id": document, "observation_index": index, "field_name": "country", "raw_value": "Peru",
        "value_type": "string", "value_json": '"Peru"', "unit": None, "confidence": None, "missing_reason": None,
        "issues": [], "evidence": [evidence], **more,
    }


@pytest.mark.parametrize("fault, rule", [
    ({}, None), ({"quote": "Chile"}, "evidence_quote_missing"), ({"start": 3}, "evidence_offsets_mismatch"),
    ({"field_name": "colour"}, "field_known"), ({"raw_value": None}, "candidate_has_value_and_evidence"),
    ({"confidence": 2.0}, "confidence_in_range"), ({"missing_reason": "not_found"}, "abstention_has_no_value"),
])
def test_foreign_extractors_are_taken_whole_or_not(spark, fault, rule):
    start = TEXT.index("Peru")

    made = [observation(d, n, **({"start": start} | (fault if n == 1 and d == "d" else {}))) for d in "de" for n in (0, 1)]

    def extractor(frames):
        for frame in frames:
            yield pd.DataFrame([row for row in made if row["parsed_document_id"] in set(frame.parsed_document_id)])

    given = pages(spark, ("d", "v", 1, TEXT), ("e", "v", 1, TEXT)).coalesce(1)
    headers = spark.createDataFrame([("verra", "p", "v", d, "x" + d) for d in "de"], HEADERS)
    kept, refused = external.run_extractor(given, extractor, headers)
    assert {r.parsed_document_id for r in kept.collect()} == ({"d", "e"} if rule is None else {"e"})
    assert {(r.parsed_document_id, r.rule) for r in refused.collect()} == (set() if rule is None else {("d", rule)})


def test_foreign_rows_about_unknown_documents_and_repeated_indexes(spark):
    start = TEXT.index("Peru")

    made = [observation(d, 0, start=start) for d in "ddz"]

    def extractor(frames):
        for _ in frames:
            yield pd.DataFrame(made)

    headers = spark.createDataFrame([("verra", "p", "v", "d", "xd")], HEADERS)
    kept, refused = external.run_extractor(pages(spark, ("d", "v", 1, TEXT)).coalesce(1), extractor, headers)
    assert kept.isEmpty()
    assert {(r.parsed_document_id, r.rule) for r in refused.collect()} == {
        ("d", "index_not_sequential"), ("z", "document_unknown"), ("z", "evidence_page_missing"),
    }


CHECKS = OBSERVATIONS + ", validation_run_id string, status string, issue_codes array<string>"


def report(spark, *rows):
    made = [
        ("verra", "p", "v", "d", "x", n, "country", v, "string", f'"{v}"', None, None, None, [], [], run, "needs_review", [])
        for run, n, v in rows
    ]
    return spark.createDataFrame(made, CHECKS)


def test_stored_reports_never_change(spark):
    first = report(spark, ("r", 0, "a"), ("r", 1, "b"), ("s", 0, "a"))
    stored = review.report_digests(first)
    again = review.report_digests(first.orderBy(F.desc("observation_index")).repartition(3))
    assert review.import_conflicts(again, stored).isEmpty()
    for changed in (
        report(spark, ("r", 0, "a"), ("r", 1, "c")), report(spark, ("r", 0, "a")), report(spark, ("r", 0, "a"), ("r", 1, "b"), ("r", 1, "b")),
    ):
        got = review.import_conflicts(review.report_digests(changed), stored).collect()
        assert [(r.validation_run_id, r.rule) for r in got] == [("r", "stored_report_differs")]
    none = spark.createDataFrame([], "validation_run_id string, rule string")
    candidates, _ = review.import_validation(report(spark, ("r", 0, "a"), ("t", 0, "a")), none, stored)
    assert [r.validation_run_id for r in candidates.collect()] == ["t"]


def test_stored_runs_never_change(spark):
    runs = spark.createDataFrame([("x", "h1"), ("r", "h"), ("q", "h")], "pipeline_run_id string, input_hash string")
    stored = spark.createDataFrame([("x", "h2"), ("q", "h")], "pipeline_run_id string, input_hash string")
    reports = spark.createDataFrame([("r", "x"), ("q", "y")], "validation_run_id string, extraction_run_id string")
    got = review.run_conflicts(reports, runs, stored).collect()
    assert [(r.validation_run_id, r.rule) for r in got] == [("r", "stored_run_differs")]


def test_violated_gold_samples_are_not_scored(spark):
    labels = spark.createDataFrame(
        [("g", s, "test", "frozen", "confirmed", "p", "country", '"a"', None) for s in ("one", "two")],
        "dataset_version string, sample_id string, split string, sample_status string, label_status string, project_id string, "
        "field_name string, value_json string, unit string",
    )
    seen = report(spark, ("r", 0, "a")).select("project_id", "field_name", "missing_reason", "value_json", "unit", "evidence")
    wrong = spark.createDataFrame([("g", "two", "project_id_differs")], "dataset_version string, sample_id string, rule string")
    got = evaluate.gold_evaluate(labels, seen, ["project_id", "field_name"], wrong).collect()
    assert [(r.sample_id, r.outcome) for r in got] == [("one", "exact_match")]


def test_projects_without_facts_and_contexts_without_facts_have_rows(spark):
    facts = spark.createDataFrame(
        [("verra", "a", "methodology_name", "f", '"ACM0002"', None)],
        "registry string, project_id string, field_name string, fact_id string, value_json string, unit string",
    )
    contexts = spark.createDataFrame(
        [("verra", "b", True, "f", "g", {"be_value_tco2e": "h"})],
        "registry string, project_id string, authority_confirmed boolean, methodology_fact_id string, "
        "methodology_version_fact_id string, period_fact_ids map<string,string>",
    )
    sources = spark.createDataFrame([("verra", "c"), ("verra", "a")], "registry string, project_id string")
    ready = assess.readiness(facts, assess.project_spine(facts, contexts, sources)).collect()
    assert {r.project_id for r in ready} == {"a", "b", "c"} and len(ready) == 36
    assert all(r.status == "missing_inputs" and r.fact_ids == [] for r in ready if r.project_id != "a")
    gates = {r.project_id: r.gates for r in assess.business_gates(facts, contexts).collect()}
    assert gates["a"] == ["methodology_version_missing", "assessment_context_missing"]
    assert gates["b"] == [
        "methodology_scope_unconfirmed", "methodology_version_missing", "context_fact_identity_mismatch:methodology_name",
        "context_fact_identity_mismatch:methodology_version", "context_fact_identity_mismatch:be_value_tco2e",
    ]


def test_manifest_lines_that_are_broken(spark, tmp_path):
    good = {"relative_path": "a/b.txt", "size_bytes": 5, "sha256": "0" * 64, "content_type": "text/plain", "registry": "verra"}
    lines = [
        json.dumps({"root_label": "x", "row_count": 2, "total_bytes": 10}), json.dumps(good), json.dumps({**good, "size_bytes": "5x"}),
        '{"relative_path": "cut', "[1]", "", json.dumps({**good, "sha256": "q", "registry": "nowhere", "source_url": "x"}),
    ]
    path = tmp_path / "m.jsonl"
    path.write_text("\n".join(lines))
    got = sorted(r.rule for r in manifest.manifest_line_violations(spark.read.text(str(path))).collect())
    assert got == sorted(
        ["line_broken"] * 3 + ["path_repeated"] * 2 + ["sha256_invalid", "registry_unknown", "url_not_absolute"]
    )
    assert manifest.read_manifest(spark, str(path)).count() == 2
    rows = spark.read.text(str(path)).where("value NOT LIKE '%root_label%'")
    assert "header_missing" in {r.rule for r in manifest.manifest_line_violations(rows).collect()}


@pytest.mark.parametrize("name", ["external_extraction", "external_refusals", "document_extraction"])
def test_sql_agrees(spark, name):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    assert compare(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) == []
