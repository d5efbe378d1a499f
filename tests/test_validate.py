import pytest

from attestry.operators.consistency import issue_links, project_consistency
from attestry.operators.grounding import locate_quotes
from attestry.operators.validate import validate, validation_counts
from attestry.schemas import OBSERVATIONS, PAGES

NUMBER, TEXT, FLAG = "double", "string", "bool"


def observation(index, field, value, kind, page_text, quote=None, confidence=None, unit=None,
                missing=None, run="x", version="v", start=0):
    if missing:
        return ("verra", "VCS1", version, "d", run, index, field, None, None, None, None, None,
                missing, [], [])
    spelled = f'"{value}"' if kind == TEXT else str(value).lower()
    quote = page_text if quote is None else quote
    evidence = [("v", 1, quote, start, start + len(quote))]
    return ("verra", "VCS1", version, "d", run, index, field, str(value), kind, spelled, unit,
            confidence, None, [], evidence)


def checked(spark, rows, text):
    pages = spark.createDataFrame([("d", "v", 1, text)], PAGES)
    found = validate(spark.createDataFrame(rows, OBSERVATIONS), pages)
    return {r.observation_index: r for r in found.collect()}


@pytest.mark.parametrize(
    "field,value,kind,status,code",
    [
        ("installed_capacity_mw", True, FLAG, "rejected", "field_type_invalid"),
        ("installed_capacity_mw", 12, TEXT, "rejected", "field_type_invalid"),
        ("installed_capacity_mw", -12, "int", "rejected", "numeric_range_invalid"),
        ("registered_date", "2023-02-29", TEXT, "rejected", "date_calendar_invalid"),
        ("registered_date", "03/04/2020", TEXT, "needs_review", "date_format_unresolved"),
        ("registered_date", "2020", TEXT, "needs_review", "date_format_unresolved"),
        ("be_value_tco2e", -5.0, NUMBER, "needs_review", "negative_value_requires_domain_rule"),
        ("baseline_assumptions_table", True, FLAG, "needs_review", "field_contract_pending"),
        ("project_name", "  ", TEXT, "rejected", "field_type_invalid"),
    ],
)
def test_types_ranges_and_dates(spark, field, value, kind, status, code):
    text = f"Recorded value: {value}"
    row = checked(spark, [observation(0, field, value, kind, text)], text)[0]
    assert row.status == status and code in row.issue_codes


def test_confident_exact_value_still_needs_a_reader(spark):
    text = "Recorded value: 2024-02-29"
    row = checked(
        spark, [observation(0, "registered_date", "2024-02-29", TEXT, text, confidence=0.99)], text
    )[0]
    assert (row.status, row.issue_codes) == ("needs_review", ["semantic_support_pending"])
    assert row.validation_issues[0].severity == "review"


def test_conflicts_units_and_abstentions(spark):
    text = "Recorded value: 12"
    rows = [
        observation(0, "installed_capacity_mw", 12, "int", text, confidence=0.79),
        observation(1, "installed_capacity_mw", 14, "int", text, confidence=0.79),
        observation(2, "country", None, None, text, missing="not_found"),
        observation(3, "ef_unit", None, None, text, missing="ambiguous"),
    ]
    got = checked(spark, rows, text)
    assert [got[n].status for n in range(4)] == [
        "needs_review", "needs_review", "missing", "needs_review",
    ]
    assert {"candidate_conflict", "unit_unverified", "confidence_below_threshold"} <= set(
        got[0].issue_codes
    )
    pages = spark.createDataFrame([("d", "v", 1, text)], PAGES)
    counts = validation_counts(validate(spark.createDataFrame(rows, OBSERVATIONS), pages)).first()
    assert (counts.missing, counts.rejected, counts.needs_review) == (1, 0, 3)


def test_typed_values_with_equal_text_conflict(spark):
    text = "Recorded value: 12"
    rows = [
        observation(0, "ef_value", 12, "int", text), observation(1, "ef_value", 12.0, NUMBER, text),
    ]
    assert "candidate_conflict" in checked(spark, rows, text)[0].issue_codes


def test_evidence_faults(spark):
    text = "Recorded value: Example Project"
    rows = [
        observation(0, "project_name", "A", TEXT, text, quote="invented quote"),
        observation(1, "project_owner", "B", TEXT, text, quote="Recorded", start=3),
        observation(2, "project_operator", "C", TEXT, text, version="other"),
    ]
    got = checked(spark, rows, text)
    assert got[0].issue_codes[0] == "evidence_quote_missing"
    assert got[1].issue_codes[0] == "evidence_offsets_invalid"
    assert got[2].issue_codes[0] == "evidence_version_invalid"
    assert {got[n].status for n in range(3)} == {"rejected"}


def test_threshold_must_be_a_share(spark):
    with pytest.raises(ValueError):
        validate(spark.createDataFrame([], OBSERVATIONS), spark.createDataFrame([], PAGES), 1.5)


def test_quote_location(spark):
    pages = spark.createDataFrame([("d", "v", 1, "aXaXa b")], PAGES)
    quotes = spark.createDataFrame(
        [("d", 1, "aXa"), ("d", 1, "b"), ("d", 1, "zz"), ("d", 2, "b")],
        "parsed_document_id string, page_number int, quote string",
    )
    got = {(r.page_number, r.quote): (r.occurrence, r.char_start) for r in
           locate_quotes(quotes, pages).collect()}
    assert got == {
        (1, "aXa"): ("ambiguous", None), (1, "b"): ("unique", 6), (1, "zz"): ("absent", None),
        (2, "b"): ("page_missing", None),
    }


CHECKS = (
    "registry string, project_id string, validation_run_id string, observation_index int, "
    "field_name string, value_type string, value_json string, unit string, "
    "missing_reason string, status string"
)
VERSIONS = "validation_run_id string, source_document_id string, document_version_id string"


def consistency(spark, rows, sources):
    checks = spark.createDataFrame(
        [("verra", "p", run, n, field, kind, value, None, None, status)
         for n, (run, field, kind, value, status) in enumerate(rows)], CHECKS,
    )
    versions = spark.createDataFrame(sources, VERSIONS)
    issues, status = project_consistency(checks, versions)
    links = issue_links(issues, checks)
    return (
        {r.code for r in issues.collect()},
        status.first().cross_document_comparison,
        links.count(),
    )


def test_differences_between_versions_and_documents(spark):
    two = [("a", "capacity"), ("b", "capacity")]
    rows = [(run, "installed_capacity_mw", "double", v, "needs_review")
            for (run, _), v in zip(two, ("12.0", "14.0"))]
    codes, status, links = consistency(spark, rows, [("a", "s", "v1"), ("b", "s", "v2")])
    assert "cross_version_difference" in codes and status == "performed"
    codes, _, _ = consistency(spark, rows, [("a", "s1", "v1"), ("b", "s2", "v2")])
    assert "cross_document_difference" in codes
    codes, status, _ = consistency(spark, rows, [("a", "s", "v"), ("b", "s", "v")])
    assert "extractor_difference" in codes and status == "not_possible"
    rejected = [rows[0][:4] + ("rejected",), rows[1]]
    codes, _, _ = consistency(spark, rejected, [("a", "s", "v1"), ("b", "s", "v2")])
    assert codes == {"methodology_scope_unconfirmed"}


@pytest.mark.parametrize(
    "start,end,code",
    [
        ('"2022-01-01"', '"2021-01-01"', "date_order_reversed"),
        ('"2020"', '"2021-01-01"', "date_pair_not_evaluable"),
        (None, '"2021-01-01"', "date_pair_incomplete_or_conflicting"),
        ('"2020-01-01"', '"2021-01-01"', None),
    ],
)
def test_date_pairs(spark, start, end, code):
    rows = [("a", "methodology_name", "string", '"ACM0002"', "needs_review")]
    for field, value in (("crediting_period_start", start), ("crediting_period_end", end)):
        if value:
            rows.append(("a", field, "string", value, "needs_review"))
    codes, _, links = consistency(spark, rows, [("a", "s", "v")])
    assert codes == ({code} if code else set())
    assert links == (len(rows) - 1 if code else 0)
