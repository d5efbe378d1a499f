"""Literal rows for rules that one generated query alone does not prove."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from attestry.operators import canonical, consistency, evaluate, extract, keywords, pages, replies, versions
from attestry.sources import manifest, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def arrival(source, title, sha, day, name):
    return Row(
        registry="verra", registry_project_id="1", source_url=source, document_type="other", title=title, sha256=sha,
        content_type="application/pdf", file_name=name, byte_size=1, declared_version="1", retrieved_at=dt.datetime(2024, 1, day),
    )


def test_only_the_differing_arrival_is_refused(spark):
    incoming = spark.createDataFrame([
        arrival("u", "A", "s1", 1, "a"), arrival("u", "A", "s2", 2, "b"), arrival("u", "B", "s3", 3, "c"), arrival("v", "C", "s1", 1, "d"),
    ])
    none = spark.createDataFrame([], "source_document_id string, title string")
    stored = spark.createDataFrame([], "source_document_id string, sha256 string, document_version_id string")
    sources, found, _, conflicts = versions.ingest_versions(incoming, none, stored)
    assert sorted(r.title for r in sources.collect()) == ["A", "C"]
    assert sorted(r.file_name for r in found.collect()) == ["a", "b", "d"]
    assert [(r.file_name, r.rule) for r in conflicts.collect()] == [("c", "source_metadata_conflict")]
    again = versions.ingest_versions(spark.createDataFrame([arrival("u", "B", "s3", 3, "c")]), sources, found)
    assert again[1].count() == 0 and again[3].count() == 1


def test_first_versions_pass_the_reprocess_gate(spark):
    named = spark.createDataFrame([Row(document_version_id=k) for k in (1, 2, 3)])
    stages = spark.createDataFrame([Row(document_version_id=1, stage=s) for s in ("parsed", "extracted", "validated", "reviewed")])
    before = spark.createDataFrame([Row(document_version_id=2, previous_document_version_id=1), Row(document_version_id=3, previous_document_version_id=3)])
    got = {r.document_version_id: r for r in versions.reprocess_gate(named, stages, before).collect()}
    assert got[1].promotable and got[1].previous_document_version_id is None
    assert not got[2].promotable and len(got[2].missing_stages) == 4
    assert got[3].rule == "version_equals_predecessor"


def test_acceptance_needs_a_known_policy_and_complete_reports(spark):
    metrics = "dataset_version string, split string, evaluated_fields long, conflicts long, accuracy double, confirmed_accuracy double, unknown_abstention_rate double"
    aggregated = spark.createDataFrame([(name, "test", 4, 1, 0.5, 0.5, None) for name in "abcd"], metrics)
    datasets = spark.createDataFrame(
        [("a", "frozen", "p"), ("b", "frozen", "nowhere"), ("c", "draft", "p"), ("d", "frozen", "p")],
        "dataset_version string, dataset_status string, policy_version string",
    )
    policies = spark.createDataFrame([("p", "approved")], "policy_version string, policy_status string")
    open_ = spark.createDataFrame([("d", "test", "s", "missing_report"), ("a", "validation", "s", "missing_report")], "dataset_version string, split string, sample_id string, rule string")
    got = {r.dataset_version: (r.gate, r.accuracy) for r in evaluate.accept(policies, datasets, aggregated, open_).collect()}
    assert got == {
        "a": ("accepted", 0.5), "b": ("approved_policy_required", None), "c": ("frozen_gold_required", None), "d": ("incomplete_reports", None),
    }


def test_coverage_is_per_split(spark):
    kind = "dataset_version string, split string, sample_id string"
    samples = spark.createDataFrame([("g", "test", "1"), ("g", "test", "2"), ("g", "development", "3")], kind)
    reports = spark.createDataFrame([("g", "test", "1"), ("g", "test", "1"), ("g", "test", "9"), ("g", "development", "3")], kind)
    found = evaluate.coverage_violations(samples, reports)
    assert rows(found) == [("g", "test", "1", "duplicate_report"), ("g", "test", "2", "missing_report"), ("g", "test", "9", "unexpected_report")]
    outcome = spark.createDataFrame(
        [("g", s, n, "confirmed", "exact_match", True) for s, n in (("test", "1"), ("development", "3"))],
        "dataset_version string, split string, sample_id string, label_status string, outcome string, evidence_present boolean",
    )
    assert [r.split for r in evaluate.gold_aggregate(outcome, found).collect()] == ["development"]


def test_drafts_and_foreign_identities_are_violations(spark):
    kind = "dataset_version string, sample_id string, sample_status string, run string, registry string, project_id string, document_version_id string, parsed_document_id string"
    samples = spark.createDataFrame([("g", "1", "draft", "x", "r", "p", "v", "d"), ("g", "2", "frozen", "y", "r", "q", "v", "d"), ("g", "3", "frozen", "z", "r", "p", "v", "d")], kind)
    reports = spark.createDataFrame([("x", "r", "p", "v", "d"), ("y", "r", "p", "v", None), ("z", "r", "p", "v", "d")], "run string, registry string, project_id string, document_version_id string, parsed_document_id string")
    assert rows(evaluate.gold_violations(samples, reports, "run")) == [
        ("g", "1", "draft_sample"), ("g", "2", "parsed_document_id_differs"), ("g", "2", "project_id_differs"),
    ]


def test_two_contents_of_one_identity_in_a_batch_conflict(spark):
    keyed = tables.with_result_key(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "id int, v string"))
    fresh, reused, conflicting = tables.split_by_store(keyed, keyed.limit(0), ["id"])
    assert [r.v for r in fresh.collect()] == ["c"] and reused.count() == 0
    assert sorted(r.v for r in conflicting.collect()) == ["a", "b"]


def test_pages_stored_twice_are_both_read(spark):
    documents = spark.createDataFrame([("d", "en")], "parsed_document_id string, ocr_language string")
    stored = spark.createDataFrame([("d", 1, "one"), ("d", 1, "other"), ("e", 1, "x")], "parsed_document_id string, page_number int, text string")
    assert sorted(r.text for r in pages.read_parsed(documents, stored).collect()) == ["one", "other"]


def test_links_of_reports_and_projects(spark):
    checks = spark.createDataFrame(
        [("v", "p", run, k, field, "needs_review", '"x"', None, None) for run in ("r1", "r2") for k, field in enumerate(("country", "project_name"))],
        "registry string, project_id string, validation_run_id string, observation_index int, field_name string, status string, value_json string, unit string, missing_reason string",
    )
    issues = spark.createDataFrame(
        [("v", "p", "one", "country", "r1"), ("v", "p", "all", "country,project_name", None)],
        "registry string, project_id string, code string, fields string, validation_run_id string",
    )
    got = consistency.issue_links(issues, checks)
    assert rows(got.select("code", "validation_run_id", "field_name")) == [
        ("all", "r1", "country"), ("all", "r1", "project_name"), ("all", "r2", "country"), ("all", "r2", "project_name"), ("one", "r1", "country"),
    ]
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_heads_of_touched_scopes_stay(spark):
    scope = dict(registry="v", project_id="p", field_name="country")
    candidates = spark.createDataFrame([Row(candidate_id="c", **scope)])
    decisions = spark.createDataFrame(
        [("d", "c", "me", "why", "unresolved", "f0", True, None, dt.datetime(2024, 1, 2))],
        "decision_id string, candidate_id string, reviewer string, reason string, status string, expected_current_fact_id string,"
        " authority_confirmed boolean, after struct<field_name:string,value_json:string,unit:string,evidence:array<struct<document_version_id:string,page_number:int,quote:string,char_start:int,char_end:int>>>,"
        " created_at timestamp",
    )
    verdicts = spark.createDataFrame([], "decision_id string, created_at timestamp, blocked_codes array<string>")
    heads = spark.createDataFrame([Row(fact_id="f0", value_json='"x"', **scope), Row(fact_id="f1", value_json='"y"', registry="v", project_id="q", field_name="country")])
    outcomes, facts, current = canonical.fold_decisions(decisions, candidates, verdicts, heads)
    assert [r.outcome for r in outcomes.collect()] == ["unresolved"] and facts.count() == 0
    assert [(r.project_id, r.fact_id, r.value_json) for r in current.collect()] == [("p", "f0", '"x"')]


def test_replies_are_strict(spark):
    text = "Host country: Chile"
    stored = spark.createDataFrame([("D", "V", 1, text)], "parsed_document_id string, document_version_id string, page_number int, text string")
    asked = spark.createDataFrame(
        [(k, "verra", "P", "V", "D", p, ["country"]) for k, p in (
            ("int", [1]), ("double", [1]), ("string", [1]), ("bool", [1]), ("power", [1]), ("raw", [1]), ("object", [1]),
            ("twice", [1, 1]), ("far", [1, 9]), ("key", [1]))],
        "request_id string, registry string, project_id string, document_version_id string, parsed_document_id string, page_numbers array<int>, requested_fields array<string>",
    )

    def body(value, raw='"Chile"', extra=""):
        return (
            f'{{"observations":[{{{extra}"field_name":"country","raw_value":{raw},"normalized_value":{value},"unit":null,'
            f'"evidence":[{{"page_number":1,"quote":"{text}"}}],"missing_reason":null}}]}}'
        )

    given = spark.createDataFrame([
        ("int", body("12")), ("double", body("12.0")), ("string", body('"12"')), ("bool", body("true")), ("power", body("1e3")),
        ("raw", body('"x"', raw="5")), ("object", body('{"a":1}')), ("twice", body("12")), ("far", body("12")),
        ("key", body("12", extra='"note":1,')), ("nobody", body("12")),
    ], "request_id string, body string")
    found, violations = replies.ground_replies(given, asked, stored)
    assert {r.request_id: (r.value_type, r.value_json) for r in found.collect()} == {
        "int": ("int", "12"), "double": ("double", "12.0"), "string": ("string", '"12"'), "bool": ("bool", "true"), "power": ("double", "1000.0"),
    }
    assert rows(violations) == [
        ("far", "pages_page_outside_document"), ("key", "unknown_key"), ("nobody", "request_unknown"), ("object", "value_not_scalar"),
        ("raw", "raw_value_not_text"), ("twice", "pages_not_unique"),
    ]


def test_whole_values_and_refused_matches(spark):
    long = "Chile " + "and more " * 40
    made = spark.createDataFrame(
        [("D", "V", 1, f"Host country: {long}x\nProject title: A\nValidator: 1\n")],
        "parsed_document_id string, document_version_id string, page_number int, text string",
    )
    kept = {r.field_name: r.value_string for r in extract.extract_matches(made).collect()}
    assert kept["country"] == long + "x"
    cut = extract.extract_matches(made, limits=extract.Limits(text_length=10))
    assert {r.value_string for r in cut.where("field_name = 'country'").collect()} == {long[:10]}
    assert rows(extract.refused_matches(made).select("field_name", "refused")) == [("project_name", "length"), ("validator_name", "few_letters")]


def test_keyword_scopes_of_several_pages(spark):
    made = spark.createDataFrame(
        [("a", 1, 2, "project boundary"), ("a", 2, 1, "grid-connected project boundary"), ("a", 1, 1, "eligible applicability")],
        "scope string, document int, page_number int, text string",
    )
    found = keywords.keyword_evidence(made, ["scope"], page_order=("document", "page_number"), most=None)
    first = {r.pattern: (r.document, r.page_number) for r in found.where("dimension_id = 'D01'").collect()}
    assert first["project boundary"] == (1, 2) and first["eligible"] == (1, 1) and first["grid[- ]connected"] == (2, 1)
    ranks = [r.evidence_rank for r in found.where("dimension_id = 'D01'").collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1)) and len(ranks) > 3


def test_manifest_keeps_underscored_names(spark):
    files = spark.createDataFrame([("A/_x.txt", b"ab"), ("A/.y.txt", b"c"), (".h/z.txt", b"d"), ("top.pdf", b"")], "relative_path string, content binary")
    got = {r.relative_path: (r.size_bytes, r.project_id, r.content_type) for r in manifest.describe_files(files).collect()}
    assert got == {"A/_x.txt": (2, "A", "text/plain"), "top.pdf": (0, None, "application/pdf")}
    assert manifest.manifest_violations(manifest.describe_files(files)).select(F.col("rule")).collect()[0].rule == "size_not_positive"
