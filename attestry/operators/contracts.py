"""Invariants of every table as set-based checks that return (table, key, rule) rows.

Row rules are filters, uniqueness and sum rules are aggregates with a condition, reference rules are
anti joins. An empty result means the table keeps its contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.catalog import (
    BINDABLE_FIELDS,
    CRITERIA,
    DIMENSION_INPUTS,
    DOCUMENT_TYPES,
    FIELDS,
    OUTCOMES,
    REGISTRIES,
    RUN_STATUSES,
    SPLITS,
    STAGES,
)
from attestry.functions.dates import strict_date
from attestry.functions.text import is_blank
from attestry.operators.pages import page_sequence

SHA256 = r"^[0-9a-f]{64}\z"


def _key(columns: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("key")


def _broken(df: DataFrame, table: str, key: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Rows that meet a rule's violation condition; a null condition counts as broken."""
    found = F.explode(broken_rules(rules)).alias("rule")
    return df.select(F.lit(table).alias("table"), _key(key), found)


def _repeated(df: DataFrame, table: str, key: Sequence[str], rule: str) -> DataFrame:
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return counted.select(F.lit(table).alias("table"), _key(key), F.lit(rule).alias("rule"))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def evidence_rules() -> dict[str, Column]:
    """Violation conditions over flat evidence columns."""
    start, end = F.col("char_start"), F.col("char_end")
    return {
        "offsets_both_or_none": start.isNull() != end.isNull(),
        "end_after_start": F.coalesce((start < 0) | (end <= start), F.lit(False)),
        "page_positive": F.col("page_number") < 1,
        "quote_not_empty": F.length("quote") == 0,
    }


def check_evidence(evidence: DataFrame, key: Sequence[str]) -> DataFrame:
    return _broken(evidence, "evidence", key, evidence_rules())


def check_pages(pages: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """``documents`` carries the recognition engine of each parse, if it is to be checked."""
    rows = _broken(
        pages,
        "parsed_pages",
        ["parsed_document_id", "page_number"],
        {
            "offsets_span_text": (F.col("char_start") != 0)
            | (F.col("char_end") != F.length("text"))
        },
    )
    numbered = page_sequence(pages)
    gaps = numbered.where(~F.coalesce("sequential", F.lit(False))).select(
        F.lit("parsed_pages").alias("table"),
        _key(["parsed_document_id"]),
        F.lit("pages_sequential").alias("rule"),
    )
    if documents is None:
        return _all([rows, gaps])
    used = pages.groupBy("parsed_document_id").agg(F.max("used_ocr").alias("_used"))
    engine = _broken(
        documents.join(used, "parsed_document_id", "left"),
        "parsed_documents",
        ["parsed_document_id"],
        {
            "engine_name_with_version": F.col("ocr_engine_name").isNull()
            != F.col("ocr_engine_version").isNull(),
            "ocr_pages_need_engine": F.coalesce("_used", F.lit(False))
            & F.col("ocr_engine_name").isNull(),
            "has_pages": F.col("_used").isNull(),
        },
    )
    return _all([rows, gaps, engine])


def check_runs(runs: DataFrame) -> DataFrame:
    running = F.col("status") == "running"
    failed = F.col("status") == "failed"
    errors = F.coalesce(F.length("error_code") > 0, F.lit(False)) & F.coalesce(
        F.length("error_message") > 0, F.lit(False)
    )
    stray = F.col("error_code").isNotNull() | F.col("error_message").isNotNull()
    return _broken(
        runs,
        "processing_runs",
        ["pipeline_run_id"],
        {
            "finish_after_start": F.coalesce(
                F.col("finished_at") < F.col("started_at"), F.lit(False)
            ),
            "running_without_finish": running != F.col("finished_at").isNull(),
            "failed_with_error": failed & ~errors,
            "error_only_when_failed": ~failed & stray,
            "stage_known": ~F.col("stage").isin(*STAGES),
            "status_known": ~F.col("status").isin(*RUN_STATUSES),
        },
    )


def observation_rules(fields: Sequence[str] = FIELDS) -> dict[str, Column]:
    """Violation conditions over observation columns; ``fields`` are those that may be filled."""
    valued = F.col("missing_reason").isNull()
    carries = F.col("raw_value").isNotNull() | F.col("value_json").isNotNull()
    complete = (
        F.col("raw_value").isNotNull()
        & F.col("value_json").isNotNull()
        & (F.coalesce(F.size("evidence"), F.lit(0)) > 0)
    )
    version = F.col("document_version_id")
    foreign = F.exists("evidence", lambda e: e["document_version_id"] != version)
    return {
        "candidate_has_value_and_evidence": valued & ~complete,
        "abstention_has_no_value": ~valued & carries,
        "evidence_of_own_version": F.coalesce(foreign, F.lit(False)),
        "run_identity_present": F.col("extraction_run_id").isNull(),
        "field_known": ~F.col("field_name").isin(*fields),
        "confidence_in_range": F.coalesce(~F.col("confidence").between(0, 1), F.lit(False)),
    }


def check_observations(observations: DataFrame) -> DataFrame:
    return _broken(
        observations, "observations", ["extraction_run_id", "observation_index"], observation_rules()
    )


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that a row breaks; a null condition counts as broken."""
    return F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(True)), rule) for rule, bad in rules.items()])
    )


def check_validation(checks: DataFrame) -> DataFrame:
    error = F.exists("validation_issues", lambda i: i["severity"] == "error")
    rows = _broken(
        checks,
        "validation_reports",
        ["extraction_run_id", "observation_index"],
        {
            "rejected_with_error": (F.col("status") == "rejected") != error,
            "missing_is_abstention": (F.col("status") == "missing")
            & F.col("missing_reason").isNull(),
        },
    )
    once = checks.groupBy("extraction_run_id", "observation_index").agg(
        F.count(F.lit(1)).alias("_n")
    )
    sequence = (
        once.groupBy("extraction_run_id")
        .agg(
            F.sum("_n").alias("_rows"),
            F.count(F.lit(1)).alias("_distinct"),
            F.min("observation_index").alias("_first"),
            F.max("observation_index").alias("_last"),
        )
        .where("_first != 0 OR _last != _rows - 1 OR _distinct != _rows")
        .select(
            F.lit("validation_reports").alias("table"),
            _key(["extraction_run_id"]),
            F.lit("indices_sequential").alias("rule"),
        )
    )
    return _all([rows, sequence])


def check_consistency(reports: DataFrame, links: DataFrame, checks: DataFrame) -> DataFrame:
    """Inputs are unique and of one project each, links resolve, linked fields belong to the issue."""
    unique = _repeated(reports, "consistency", ["validation_run_id"], "inputs_unique")
    mixed = (
        reports.groupBy("consistency_run_id")
        .agg(
            (F.min(F.struct("registry", "project_id")) != F.max(F.struct("registry", "project_id")))
            .alias("_mixed")
        )
        .where("_mixed")
        .select(
            F.lit("consistency").alias("table"),
            _key(["consistency_run_id"]),
            F.lit("one_project").alias("rule"),
        )
    )
    known = checks.select(
        "validation_run_id", "observation_index", F.col("field_name").alias("_field")
    )
    joined = links.join(known, ["validation_run_id", "observation_index"], "left")
    linked = _broken(
        joined,
        "consistency",
        ["validation_run_id", "observation_index", "code"],
        {
            "link_resolves": F.col("_field").isNull(),
            "link_field_in_issue": F.coalesce(
                ~F.array_contains(F.split("fields", ","), F.col("_field")), F.lit(False)
            ),
        },
    )
    return _all([unique, mixed, linked])


def check_review(decisions: DataFrame) -> DataFrame:
    approved = F.col("status") == "approved"
    evidenced = F.coalesce(
        F.col("authority_confirmed")
        & F.col("after").isNotNull()
        & F.col("after.missing_reason").isNull(),
        F.lit(False),
    )
    supplied = F.col("after").isNotNull() | F.coalesce("authority_confirmed", F.lit(False))
    return _broken(
        decisions,
        "review_requests",
        ["decision_id"],
        {
            "reviewer_not_blank": is_blank(F.col("reviewer")),
            "reason_not_blank": is_blank(F.col("reason")),
            "approval_with_authority_and_value": approved & ~evidenced,
            "value_only_with_approval": ~approved & supplied,
            "status_known": ~F.col("status").isin("approved", "rejected", "unresolved"),
        },
    )


def check_judgments(judgments: DataFrame) -> DataFrame:
    decisive = F.col("outcome").isin("supported", "not_supported", "not_applicable")
    basis = (F.coalesce(F.size("fact_ids"), F.lit(0)) > 0) & (
        F.coalesce(F.size("evidence"), F.lit(0)) > 0
    )
    rows = _broken(
        judgments,
        "judgments",
        ["request_id", "criterion_id"],
        {
            "criterion_known": ~F.col("criterion_id").isin(*CRITERIA),
            "outcome_known": ~F.col("outcome").isin(*OUTCOMES),
            "reason_not_blank": is_blank(F.col("reason")),
            "facts_distinct": F.size(F.array_distinct("fact_ids")) != F.size("fact_ids"),
            "decisive_needs_basis": decisive & ~basis,
        },
    )
    repeated = _repeated(
        judgments, "judgments", ["request_id", "criterion_id"], "criterion_once_per_request"
    )
    return _all([rows, repeated])


def check_evaluations(dimensions: DataFrame) -> DataFrame:
    """Coverage of each dimension is a partition and each request has exactly twelve dimensions."""
    reviewed, open_ = F.col("reviewed_criterion_ids"), F.col("unreviewed_criterion_ids")
    mine = F.filter(
        F.array(*map(F.lit, CRITERIA)), lambda c: c.startswith(F.col("dimension_id"))
    )
    rows = _broken(
        dimensions,
        "evaluation_results",
        ["request_id", "dimension_id"],
        {
            "coverage_is_partition": F.arrays_overlap(reviewed, open_)
            | (F.array_sort(F.concat(reviewed, open_)) != F.array_sort(mine))
        },
    )
    counted = dimensions.where(F.col("dimension_id").isin(*DIMENSION_INPUTS)).groupBy(
        "request_id"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.col("dimension_id") == d).alias(f"_{d}") for d in DIMENSION_INPUTS],
    )
    complete = reduce(Column.__and__, [F.coalesce(f"_{d}", F.lit(False)) for d in DIMENSION_INPUTS])
    wrong = counted.where(~complete | (F.col("_n") != len(DIMENSION_INPUTS))).select(
        F.lit("evaluation_results").alias("table"),
        _key(["request_id"]),
        F.lit("exactly_twelve_dimensions").alias("rule"),
    )
    return _all([rows, wrong])


def check_contexts(contexts: DataFrame) -> DataFrame:
    start, end = strict_date(F.col("period_start")), strict_date(F.col("period_end"))
    fields, facts = F.map_keys("period_fact_ids"), F.map_values("period_fact_ids")
    return _broken(
        contexts,
        "assessment_context",
        ["registry", "project_id"],
        {
            "period_is_calendar_date": start.isNull() | end.isNull(),
            "period_in_order": F.coalesce(start > end, F.lit(False)),
            "fields_bindable": F.size(
                F.array_except(fields, F.array(*map(F.lit, BINDABLE_FIELDS)))
            )
            > 0,
            "binding_present": F.size(fields) == 0,
            "facts_distinct": F.size(F.array_distinct(facts)) != F.size(facts),
            "reviewer_not_blank": is_blank(F.col("reviewer")),
            "reason_not_blank": is_blank(F.col("reason")),
            "evidence_present": F.coalesce(F.size("evidence"), F.lit(0)) == 0,
        },
    )


def check_policies(weights: DataFrame) -> DataFrame:
    """``weights`` has one row per policy and dimension, with the policy's own columns repeated."""
    per_policy = weights.groupBy("policy_version").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.col("dimension_id") == d).alias(f"_{d}") for d in DIMENSION_INPUTS],
        F.count("weight").alias("_weights"),
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_sum"),
        F.min(F.col("weight").between(0, 1)).alias("_in_range"),
        F.max("status").alias("_status"),
        F.max(
            (F.coalesce(F.size("authority_sources"), F.lit(0)) > 0)
            & F.col("approved_by").isNotNull()
            & F.col("approved_on").isNotNull()
        ).alias("_authority"),
    )
    complete = reduce(Column.__and__, [F.coalesce(f"_{d}", F.lit(False)) for d in DIMENSION_INPUTS])
    approved = F.col("_status") == "approved"
    return _broken(
        per_policy,
        "scoring_policy",
        ["policy_version"],
        {
            "twelve_distinct_dimensions": ~complete | (F.col("_n") != len(DIMENSION_INPUTS)),
            "weights_in_range": ~F.coalesce("_in_range", F.lit(True)),
            "approved_has_all_weights": approved & (F.col("_weights") != F.col("_n")),
            "approved_weights_sum_to_one": approved & (F.abs(F.col("_sum") - 1) > 1e-9),
            "approved_has_authority": approved & ~F.col("_authority"),
            "status_known": ~F.col("_status").isin("draft", "approved", "retired"),
        },
    )


def check_datasets(datasets: DataFrame, labels: DataFrame) -> DataFrame:
    """Gold datasets (dataset_version, status, frozen_at) against the samples that name them."""
    key = ["dataset_version"]
    frozen = F.col("status") == "frozen"
    rows = _broken(
        datasets,
        "gold_datasets",
        key,
        {
            "frozen_dataset_needs_time": frozen & F.col("frozen_at").isNull(),
            "dataset_status_known": ~F.col("status").isin("draft", "frozen"),
        },
    )
    samples = labels.groupBy("dataset_version", "sample_id").agg(
        F.max(F.col("sample_status") != "frozen").alias("_open"),
        (F.min("project_id") != F.max("project_id")).alias("_two"),
    )
    named = samples.join(datasets.select(*key, "status"), key, "left")
    open_ = named.where(frozen & F.col("_open")).select(
        F.lit("gold_samples").alias("table"), _key(["dataset_version", "sample_id"]),
        F.lit("frozen_dataset_needs_frozen_samples").alias("rule"),
    )
    unknown = named.where("status IS NULL").select(
        F.lit("gold_samples").alias("table"), _key(["dataset_version", "sample_id"]),
        F.lit("dataset_version_known").alias("rule"),
    )
    two = named.where("_two").select(
        F.lit("gold_samples").alias("table"), _key(["dataset_version", "sample_id"]),
        F.lit("sample_once").alias("rule"),
    )
    empty = datasets.join(samples, key, "left_anti").select(
        F.lit("gold_datasets").alias("table"), _key(key), F.lit("dataset_has_samples").alias("rule")
    )
    return _all([rows, open_, unknown, two, empty])


def check_gold(labels: DataFrame) -> DataFrame:
    """``labels`` has one row per sample and field, with the sample's own columns repeated."""
    confirmed = F.col("label_status") == "confirmed"
    evidence = F.coalesce(F.size("evidence"), F.lit(0)) > 0
    frozen = F.col("sample_status") == "frozen"
    rows = _broken(
        labels,
        "gold_labels",
        ["dataset_version", "sample_id", "field_name"],
        {
            "confirmed_has_value_and_evidence": confirmed
            & ~(F.col("value_json").isNotNull() & evidence),
            "open_label_has_no_value": ~confirmed & (F.col("value_json").isNotNull() | evidence),
            "label_status_known": ~F.col("label_status").isin(
                "confirmed", "unknown", "conflicting"
            ),
            "reason_not_blank": is_blank(F.col("reason")),
            "split_known": ~F.col("split").isin(*SPLITS),
            "frozen_needs_two_reviewers": frozen & (F.size("reviewers") < 2),
            "reviewer_not_blank": F.exists("reviewers", is_blank),
            "frozen_needs_adjudicator": frozen
            & (is_blank(F.col("adjudicator")) | F.col("frozen_at").isNull()),
            "frozen_without_conflict": frozen & (F.col("label_status") == "conflicting"),
        },
    )
    fields = _repeated(
        labels, "gold_labels", ["dataset_version", "sample_id", "field_name"], "field_once"
    )
    pending = (
        labels.groupBy("dataset_version", "sample_id")
        .agg(
            F.max("sample_status").alias("_status"),
            F.max(F.col("label_status") == "conflicting").alias("_conflict"),
        )
        .where("_status = 'adjudication_required' AND NOT _conflict")
        .select(
            F.lit("gold_samples").alias("table"),
            _key(["dataset_version", "sample_id"]),
            F.lit("adjudication_needs_conflict").alias("rule"),
        )
    )
    leaked = (
        labels.groupBy("dataset_version", "project_id")
        .agg(F.min("split").alias("_low"), F.max("split").alias("_high"))
        .where("_low != _high")
        .select(
            F.lit("gold_samples").alias("table"),
            _key(["dataset_version", "project_id"]),
            F.lit("project_in_one_split").alias("rule"),
        )
    )
    return _all([rows, fields, pending, leaked])


def check_versions(versions: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    rows = _broken(
        versions,
        "document_versions",
        ["document_version_id"],
        {
            "sha256_valid": ~F.col("sha256").rlike(SHA256),
            "byte_size_positive": F.col("byte_size") <= 0,
            "file_name_present": F.length("file_name") == 0,
            "content_type_present": F.length("content_type") == 0,
        },
    )
    repeated = _repeated(
        versions, "document_versions", ["source_document_id", "sha256"], "content_once_per_source"
    )
    parts = [rows, repeated]
    if sources is not None:
        parts.append(
            _broken(
                sources,
                "source_documents",
                ["source_document_id"],
                {
                    "registry_known": ~F.col("registry").isin(*REGISTRIES),
                    "document_type_known": ~F.col("document_type").isin(*DOCUMENT_TYPES),
                    "project_present": F.length("registry_project_id") == 0,
                    "url_absolute": ~F.col("source_url").rlike("^https?://[^/]+"),
                },
            )
        )
        orphans = versions.join(sources, "source_document_id", "left_anti")
        parts.append(
            orphans.select(
                F.lit("document_versions").alias("table"),
                _key(["document_version_id"]),
                F.lit("source_exists").alias("rule"),
            )
        )
    return _all(parts)


CHECKS = {
    "evidence": check_evidence,
    "pages": check_pages,
    "runs": check_runs,
    "observations": check_observations,
    "validation": check_validation,
    "consistency": check_consistency,
    "review": check_review,
    "judgments": check_judgments,
    "evaluations": check_evaluations,
    "contexts": check_contexts,
    "policies": check_policies,
    "datasets": check_datasets,
    "gold": check_gold,
    "versions": check_versions,
}


def check_contract(name: str, *tables: DataFrame, **options) -> DataFrame:
    """Run the named check."""
    return CHECKS[name](*tables, **options)
