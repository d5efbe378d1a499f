"""Registered queries over reviews, assessments, evaluations, payloads, contracts and streams."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.catalog import CRITERIA
from attestry.operators import (
    assess,
    canonical,
    contracts,
    discover,
    evaluate,
    replies,
    review,
    validate,
)
from attestry.plans.queries import listed, query, stored_observations, validated
from attestry.session import checkpoint_root, materialize, materialize_buckets
from attestry.sources import adapters, tables
from attestry.sources.adapters import table, view
from attestry.streaming import jobs


def _identities(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: view(spark, folder, sql) for name, sql in adapters.IDENTITIES.items()}


# --------------------------------------------------------------------------------- import
def _checks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(checks, observations); checks lie by run and index, as the observations they were made from."""
    observations = stored_observations(spark, folder)
    checks = validated(spark, folder, observations).drop("validation_issues")
    return materialize_buckets(checks, validate.KEY, dealt=True), observations


def _extractions_own(observations: DataFrame) -> DataFrame:
    """The extractions' own observations: some moved a row and some changed a value."""
    index = F.col("observation_index")
    return observations.withColumns(
        {
            "unit": F.when(index % 223 == 0, "changed").otherwise(F.col("unit")),
            "observation_index": F.when(index % 211 == 0, -1 - index).otherwise(index),
        }
    )


def _earlier_reports(checks: DataFrame) -> DataFrame:
    """Digests of the reports that an earlier import stored, some of them with another unit since."""
    index = F.col("observation_index")
    earlier = checks.where("CAST(substr(validation_run_id, 2) AS BIGINT) % 4 = 1").withColumn(
        "unit", F.when(index % 227 == 0, "earlier unit").otherwise(F.col("unit"))
    )
    return review.report_digests(earlier)


def _earlier_runs(runs: DataFrame) -> DataFrame:
    """Runs as an earlier import stored them: every forty-seventh had another input."""
    number = F.substring("pipeline_run_id", 2, 20).cast("long")
    return runs.withColumn(
        "input_hash", F.when(number % 47 == 0, "earlier").otherwise(F.col("input_hash"))
    )


def _violations(
    spark: SparkSession, folder: str, checks: DataFrame, observations: DataFrame
) -> DataFrame:
    known = _identities(spark, folder)
    return review.import_violations(
        checks, adapters.keyed_pages(spark, folder), _extractions_own(observations), known,
        _earlier_reports(checks), _earlier_runs(known["runs"]),
    )


def _imported(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    checks, observations = _checks(spark, folder)
    return review.import_validation(
        checks, _violations(spark, folder, checks, observations), _earlier_reports(checks)
    )


@query
def import_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _violations(spark, folder, *_checks(spark, folder))


@query
def imported_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Reports that an earlier import stored are not written again."""
    return _imported(spark, folder)[0].select(
        "candidate_id", "validation_run_id", "observation_index", "field_name", "validation_status"
    )


@query
def imported_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return _imported(spark, folder)[1].select(
        "candidate_id", "evidence_index", "page_number", "quote", "char_start"
    )


@query
def observation_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    checks, observations = _checks(spark, folder)
    return review.observation_violations(checks, _extractions_own(observations))


# ------------------------------------------------------------------------------ canonical
def _folded(spark: SparkSession, folder: str):
    return canonical.fold_decisions(*adapters.event_decisions(spark, folder))


@query
def decision_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(spark, folder)[0].select(
        "decision_id", "outcome", listed("codes"), "fact_id", "before_value_json", "after_value_json"
    )


@query
def canonical_facts(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(spark, folder)[1].select(
        "fact_id", "decision_id", "project_id", "field_name", "value_json"
    )


@query
def canonical_heads(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(spark, folder)[2].select("project_id", "field_name", "fact_id", "value_json")


@query
def replacement_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Each recorded candidate proposed as its own replacement."""
    rows = adapters.observations(spark, folder).where("missing_reason IS NULL").withColumn(
        "candidate_id", F.concat_ws(":", "validation_run_id", "observation_index")
    )
    after = F.struct(
        "field_name", "raw_value", "value_type", "value_json", "unit", "confidence",
        "missing_reason", "issues", "evidence",
    )
    decisions = rows.select(
        F.col("candidate_id").alias("decision_id"), "candidate_id",
        F.lit("approved").alias("status"), after.alias("after"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("created_at"),
    )
    verdicts = canonical.replacement_verdicts(
        decisions, rows, adapters.keyed_pages(spark, folder)
    )
    return verdicts.select("decision_id", listed("blocked_codes"))


# --------------------------------------------------------------------------------- review
def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    codes = F.when(F.col("codes") == "", F.array().cast("array<string>")).otherwise(
        F.split("codes", ",")
    )
    return view(spark, folder, adapters.REVIEW_CANDIDATES).withColumn("issue_codes", codes)


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, adapters.REVIEW_DECISIONS)


def _latest_approved(spark: SparkSession, folder: str) -> DataFrame:
    approved = _log(spark, folder).where("status = 'approved'").select(
        F.lit("verra").alias("registry"), "project_id", "field_name", "decision_id", "created_at",
        F.concat(F.lit("F"), "decision_id").alias("fact_id"),
    )
    return canonical.current_heads(approved)


def _quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate that found a value quotes its page."""
    return _candidates(spark, folder).where("validation_status <> 'missing'").select(
        "candidate_id",
        F.lit(0).alias("evidence_index"),
        F.lit("V").alias("document_version_id"),
        F.lit(1).alias("page_number"),
        F.col("field_name").alias("quote"),
        F.lit(0).alias("char_start"),
        F.length("field_name").alias("char_end"),
    )


def _queue(spark: SparkSession, folder: str, **options) -> DataFrame:
    return review.review_queue(
        _candidates(spark, folder), _log(spark, folder), _latest_approved(spark, folder),
        evidence=_quotes(spark, folder), **options,
    )


def _shown(items: DataFrame) -> DataFrame:
    return items.select(
        "candidate_id", "review_state", "priority", "priority_score", listed("priority_reasons"),
        "decision_count", "current_fact_id", "evidence_count",
    )


@query
def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_queue(spark, folder))


@query
def review_queue_all_states(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_queue(spark, folder, include_approved=True))


@query
def review_queue_top(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty most urgent items of one field."""
    return _shown(_queue(spark, folder, field_name="country", include_approved=True, limit=50))


@query
def review_queue_counts(spark: SparkSession, folder: str) -> DataFrame:
    return review.queue_counts(_queue(spark, folder))


@query
def latest_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return review.latest_decisions(_log(spark, folder)).drop("latest_decision_at")


@query
def candidate_listing(spark: SparkSession, folder: str) -> DataFrame:
    return review.list_candidates(
        _candidates(spark, folder), _latest_approved(spark, folder)
    ).select("validation_run_id", "observation_index", "candidate_id", "expected_current_fact_id")


@query
def review_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return review.review_metrics(
        _candidates(spark, folder), _log(spark, folder),
        view(spark, folder, adapters.REVIEW_RUNS), _quotes(spark, folder),
    )


# ----------------------------------------------------------------------------- assessment
def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, adapters.PROJECT_FACTS)


def _provenance(spark: SparkSession, folder: str):
    """Chains of facts taken from the recorded candidates, some of them tampered with."""
    known = _identities(spark, folder)
    rows = adapters.observations(spark, folder).where("missing_reason IS NULL").groupBy(
        "registry", "project_id", "field_name"
    ).agg(F.min(F.struct("validation_run_id", "observation_index", "value_json", "unit")).alias("o"))
    rows = rows.select("registry", "project_id", "field_name", "o.*").withColumns(
        {
            "candidate_id": F.concat_ws(":", "validation_run_id", "observation_index"),
            "decision_id": F.concat_ws(":", F.lit("d"), "validation_run_id", "observation_index"),
            "fact_id": F.concat_ws(":", F.lit("f"), "validation_run_id", "observation_index"),
            "_odd": F.col("observation_index") % 29,
        }
    )
    # Heads, facts, decisions and candidates are all taken from these rows.
    rows = materialize(rows)
    decisions = rows.select(
        "decision_id", "candidate_id", "unit",
        F.when(F.col("_odd") == 1, "rejected").otherwise("approved").alias("status"),
        F.when(F.col("_odd") == 2, '"tampered"').otherwise(F.col("value_json")).alias(
            "after_value_json"
        ),
    )
    return assess.provenance(
        rows, rows, decisions, rows.select("candidate_id", "validation_run_id", "field_name"),
        known["reports"], known["parsed"], known["versions"], known["sources"],
    )


@query
def fact_provenance(spark: SparkSession, folder: str) -> DataFrame:
    return _provenance(spark, folder)[0].select(
        "registry", "project_id", "field_name", "fact_id", "extraction_run_id",
        "document_version_id", "source_document_id", "sha256", "source_url",
    )


@query
def provenance_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _provenance(spark, folder)[1]


@query
def readiness(spark: SparkSession, folder: str) -> DataFrame:
    """All projects that a source or a fact names."""
    facts = _facts(spark, folder)
    projects = assess.project_spine(facts, view(spark, folder, adapters.SOURCE_PROJECTS))
    return assess.readiness(facts, projects).select(
        "project_id", "dimension_id", listed("available_fields"), listed("missing_fields"),
        listed("fact_ids"), "methodology_scope", "status",
    )


@query
def stale_readiness(spark: SparkSession, folder: str) -> DataFrame:
    """Readiness stored before every nineteenth project lost its methodology version."""
    stored = assess.readiness(_facts(spark, folder))
    changed = _facts(spark, folder).where(
        "NOT (c_custkey % 19 = 0 AND field_name = 'methodology_version')"
    )
    return assess.stale_readiness(stored, assess.readiness(changed))


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder)
    contexts = adapters.project_contexts(spark, folder)
    loose = assess.ungrounded_context(contexts, facts, view(spark, folder, adapters.PROJECT_PAGES))
    return assess.business_gates(facts, contexts, loose)


@query
def business_gates(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder).select("project_id", listed("gates"))


@query
def dimension_checks(spark: SparkSession, folder: str) -> DataFrame:
    return assess.dimension_checks(_gated(spark, folder)).select(
        "project_id", "dimension_id", listed("missing_fields"), listed("period_binding_missing"),
        "deterministic_status",
    )


@query
def er_diagnostic(spark: SparkSession, folder: str) -> DataFrame:
    return assess.er_diagnostic(_gated(spark, folder)).select(
        "project_id", "er_status", F.col("recalculated").cast("double"),
        F.col("reported_minus_recalculated").cast("double"),
        F.round("absolute_error_pct", 6).cast("double").alias("absolute_error_pct"), "reason",
    )


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.judged(spark, folder).withColumn("outcome", F.expr(adapters.JUDGMENT_OUTCOME))


@query
def rubric_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return assess.rubric_coverage(_judged(spark, folder)).select(
        "request_id", "dimension_id", listed("reviewed_criterion_ids"),
        listed("unreviewed_criterion_ids"), "status",
    )


def _cited(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is a request about its customer's project with one judged criterion."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    criteria = F.array(*map(F.lit, (*CRITERIA, "D00.C0")))
    quote = F.when(order % 5 == 0, "invented").otherwise("Statement about")
    evidence = F.struct(
        F.concat(F.lit("V"), customer).alias("document_version_id"),
        F.lit(1).alias("page_number"),
        quote.alias("quote"),
        F.lit(0).alias("char_start"),
        F.length(quote).alias("char_end"),
    )
    return table(spark, folder, "orders").select(
        order.alias("request_id"),
        F.lit("verra").alias("registry"),
        F.concat(F.lit("P"), customer).alias("project_id"),
        F.element_at(criteria, (order % 37 + 1).cast("int")).alias("criterion_id"),
        F.array(F.concat(F.lit("F"), customer, F.lit("-"), (order % 19).cast("string"))).alias(
            "fact_ids"
        ),
        F.array(evidence).alias("evidence"),
    )


@query
def judgment_violations(spark: SparkSession, folder: str) -> DataFrame:
    return assess.judgment_violations(
        _cited(spark, folder), _facts(spark, folder), view(spark, folder, adapters.PROJECT_PAGES)
    )


# ----------------------------------------------------------------------------- evaluation
def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides hold every observation; each abstains from a third, and one changes some units."""
    rows = adapters.observations(spark, folder)
    odd = F.col("observation_index") % 1000 % 3

    def side(abstains: int, changes: int) -> DataFrame:
        return rows.withColumns(
            {
                "missing_reason": F.when(odd == abstains, "not_found").otherwise(F.col("missing_reason")),
                "unit": F.when((odd == changes) & (F.col("observation_index") % 5 == 0), "other").otherwise(
                    F.col("unit")
                ),
            }
        )

    return evaluate.compare_extractors(rows, side(0, 2), side(1, 9), ["extraction_run_id"])


@query
def extractor_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder)


@query
def comparison_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.comparison_counts(_compared(spark, folder), ["extraction_run_id"])


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.gold_evaluate(
        view(spark, folder, adapters.GOLD_LABELS),
        adapters.observations(spark, folder),
        ["registry", "project_id", "document_version_id", "extraction_run_id", "field_name"],
    )


@query
def gold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder).drop("project_id")


@query
def gold_sample_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.gold_sample_metrics(_gold(spark, folder))


def _coverage(spark: SparkSession, folder: str) -> DataFrame:
    """The acr dataset is complete; in the other two reports are misnamed, repeated or foreign."""
    samples = view(spark, folder, adapters.GOLD_LABELS).where("sample_status = 'frozen'").select(
        "dataset_version", "split", "sample_id"
    ).distinct()
    number = F.substring("sample_id", 2, 20).cast("long")
    faulty = F.col("dataset_version") != "acr"
    reports = samples.withColumn(
        "sample_id",
        F.when(faulty & (number % 45 == 0), F.concat(F.lit("Q"), "sample_id")).otherwise(
            F.col("sample_id")
        ),
    )
    number = F.regexp_extract("sample_id", r"(\d+)", 1).cast("long")
    again = reports.where(faulty & (number % 77 == 0))
    foreign = reports.where(faulty & (number % 99 == 0)).withColumn(
        "sample_id", F.concat(F.lit("Z"), "sample_id")
    )
    return evaluate.coverage_violations(samples, reports.unionByName(again).unionByName(foreign))


@query
def gold_coverage_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _coverage(spark, folder)


@query
def gold_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.gold_aggregate(_gold(spark, folder)).drop("conflicts")


@query
def gold_aggregate_complete(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.gold_aggregate(_gold(spark, folder), _coverage(spark, folder)).drop("conflicts")


@query
def gold_acceptance(spark: SparkSession, folder: str) -> DataFrame:
    datasets = view(spark, folder, adapters.GOLD_LABELS).groupBy("dataset_version").agg(
        F.min(F.when(F.col("dataset_version") == "verra", "draft").otherwise("frozen")).alias(
            "dataset_status"
        ),
        F.min(F.concat(F.lit("policy-"), "dataset_version")).alias("policy_version"),
    )
    policies = datasets.select(
        "policy_version",
        F.when(F.col("policy_version") == "policy-gold_standard", "draft")
        .otherwise("approved")
        .alias("policy_status"),
    )
    coverage = _coverage(spark, folder)
    complete = evaluate.gold_aggregate(_gold(spark, folder), coverage)
    return evaluate.accept(policies, datasets, complete, coverage)


@query
def gold_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Drafts, and samples whose project was written down wrongly."""
    samples = view(spark, folder, adapters.GOLD_LABELS).withColumn(
        "parsed_document_id", F.concat(F.lit("D"), F.substring("sample_id", 2, 20))
    )
    number = F.substring("sample_id", 2, 20).cast("long")
    samples = samples.withColumn(
        "project_id", F.when(number % 29 == 0, "elsewhere").otherwise(F.col("project_id"))
    ).select("dataset_version", "sample_id", "sample_status", "extraction_run_id", *evaluate.GOLD_IDENTITY).distinct()
    reports = view(spark, folder, adapters.IDENTITIES["reports"])
    return evaluate.gold_violations(samples, reports, "extraction_run_id")


# -------------------------------------------------------------------------------- replies
def _page_requests(spark: SparkSession, folder: str) -> DataFrame:
    order = F.col("l_orderkey")
    listed_pages = F.sort_array(F.collect_list("page_number"))
    return (
        adapters.recorded(spark, folder)
        .groupBy("l_orderkey", "parsed_document_id")
        .agg(listed_pages.alias("p"))
        .select(
            order.alias("request_id"),
            "parsed_document_id",
            F.when(order % 11 == 0, F.concat("p", F.slice("p", 1, 1)))
            .when(order % 13 == 0, F.concat("p", F.array(F.lit(1).cast("long"))))
            .otherwise(F.col("p"))
            .alias("page_numbers"),
        )
    )


@query
def page_selection(spark: SparkSession, folder: str) -> DataFrame:
    return replies.select_pages(
        _page_requests(spark, folder), adapters.carbon_pages(spark, folder), 4, 900
    ).select("request_id", "page_count", "character_count", "status")


@query
def selected_pages_hash(spark: SparkSession, folder: str) -> DataFrame:
    requests, pages = _page_requests(spark, folder), adapters.carbon_pages(spark, folder)
    return replies.selected_pages_hash(replies.select_pages(requests, pages, 4, 900), requests, pages)


@query
def call_costs(spark: SparkSession, folder: str) -> DataFrame:
    calls = table(spark, folder, "documents").select(
        "doc_id",
        replies.worst_case_tokens(F.col("text")).alias("input_tokens"),
        (F.col("doc_id") % 1000).alias("output_tokens"),
    )
    costs = replies.estimate_cost(calls, Decimal("0.15"), Decimal("0.60"), Decimal("0.0005"))
    return costs.withColumn("estimated_cost_usd", F.col("estimated_cost_usd").cast("double"))


@query
def pending_requests(spark: SparkSession, folder: str) -> DataFrame:
    requests = table(spark, folder, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("document_version_id"),
        F.sha2("text", 256).alias("selected_pages_hash"),
        F.array("lang", "source").alias("requested_fields"),
        F.lit("m").alias("model"),
        F.lit("v1").alias("prompt_version"),
    )
    done = requests.where("doc_id % 3 = 0").withColumn(
        "status", F.when(F.col("doc_id") % 2 == 0, "succeeded").otherwise("failed")
    )
    return replies.pending_requests(requests, done).select("doc_id", "document_version_id")


def _replies(spark: SparkSession, folder: str):
    """A stored reply about every recorded page; some are wrong in one of several ways."""
    rows = adapters.recorded(spark, folder).select(
        F.concat_ws("-", "extraction_run_id", "page_number").alias("request_id"),
        "registry", "project_id", "document_version_id", "parsed_document_id", "page_number",
        "l_suppkey", "l_linenumber",
    )
    land = F.concat(F.lit("Land "), (F.col("l_suppkey") % 25).cast("string"))
    supplier = F.col("l_suppkey") % 100
    quote = (
        F.when(supplier == 1, "nothing like this")
        .when(supplier == 2, "a")
        .otherwise(F.concat(F.lit("Host country: "), land))
    )
    page = F.when(supplier == 3, F.col("page_number") + 1).otherwise(F.col("page_number"))
    second = F.when(supplier == 4, "installed_capacity_mw").otherwise("validator_name")
    reason = F.when(supplier == 5, "null").otherwise('"not_found"')
    value = (
        F.when(supplier == 7, "12").when(supplier == 8, "12.0").when(supplier == 9, '"12"')
        .when(supplier == 10, "true").otherwise(F.concat(F.lit('"'), land, F.lit('"')))
    )
    raw_value = F.when(supplier == 11, "5").otherwise(F.concat(F.lit('"'), land, F.lit('"')))
    extra = F.when(supplier == 15, '"note":1,').otherwise("")
    body = F.when(supplier == 6, F.lit('{"observations": 1')).otherwise(
        F.concat(
            F.lit('{"observations":[{'), extra, F.lit('"field_name":"country","raw_value":'), raw_value,
            F.lit(',"normalized_value":'), value,
            F.lit(',"unit":null,"evidence":[{"page_number":'), page.cast("string"),
            F.lit(',"quote":"'), quote,
            F.lit('"}],"missing_reason":null},{"field_name":"'), second,
            F.lit('","raw_value":null,"normalized_value":null,"unit":null,"evidence":[],'
                  '"missing_reason":'),
            reason, F.lit("}]}"),
        )
    )
    stored = rows.select(
        F.when(supplier == 14, F.concat(F.lit("Z"), "request_id")).otherwise(F.col("request_id"))
        .alias("request_id"),
        body.alias("body"),
    )
    requests = rows.select(
        "request_id", "registry", "project_id", "document_version_id", "parsed_document_id",
        F.when(supplier == 12, F.array("page_number", "page_number"))
        .when(supplier == 13, F.array("page_number", F.lit(999_999)))
        .otherwise(F.array("page_number"))
        .alias("page_numbers"),
        F.array(F.lit("country"), F.lit("validator_name")).alias("requested_fields"),
    )
    return replies.ground_replies(stored, requests, adapters.carbon_pages(spark, folder))


@query
def reply_observations(spark: SparkSession, folder: str) -> DataFrame:
    return _replies(spark, folder)[0].select(
        "request_id", "observation_index", "field_name", "value_type", "value_json",
        "missing_reason",
        F.get("evidence", F.lit(0)).getField("char_start").alias("char_start"),
    )


@query
def reply_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _replies(spark, folder)[1]


@query
def extractor_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = adapters.observations(spark, folder).select("field_name", "value_type")
    named = [rows.withColumn("extractor_name", F.lit(n)) for n in ("regex", "reply")]
    return replies.union_extractions(named).groupBy("extractor_name", "field_name").agg(
        F.count(F.lit(1)).alias("observations")
    )


# ------------------------------------------------------------------------------- discovery
@query
def html_links(spark: SparkSession, folder: str) -> DataFrame:
    payloads = table(spark, folder, "pages").select(
        F.lit("acr").alias("registry"),
        F.col("page_id").cast("string").alias("project_id"),
        "url",
        F.lit(None).cast("timestamp").alias("discovered_at"),
        F.col("html").alias("body"),
    )
    return discover.html_links(payloads, "th").select("document_id", "title", "url")


@query
def grouped_json_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = discover.verra_documents(view(spark, folder, adapters.GROUP_PAYLOADS))
    return found.select("project_id", "document_id", "title", "url", "declared_version")


@query
def requested_json_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = discover.gold_standard_documents(view(spark, folder, adapters.REQUEST_PAYLOADS))
    return found.select("project_id", "document_id", "title", "url")


@query
def response_classes(spark: SparkSession, folder: str) -> DataFrame:
    return discover.classify_responses(view(spark, folder, adapters.RESPONSES)).select(
        "page_id", "status", "error_code", "body_bytes"
    )


def _sync(spark: SparkSession, folder: str) -> DataFrame:
    return discover.run_status(
        view(spark, folder, adapters.SYNC_FAILURES), view(spark, folder, adapters.SYNC_RUNS)
    )


@query
def sync_run_status(spark: SparkSession, folder: str) -> DataFrame:
    return _sync(spark, folder).select("sync_run_id", "status", "failures", "cursor_after")


@query
def sync_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return discover.sync_ledger(_sync(spark, folder)).drop("updated_at")


# ------------------------------------------------------------------------------- contracts
@query
def contract_evidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = adapters.recorded(spark, folder).select(
        "parsed_document_id", "observation_index",
        (F.col("evidence_page") - 100_000).alias("page_number"), F.coalesce("quote", F.lit("")).alias("quote"),
        "char_start",
        F.when(F.col("l_suppkey") % 7 == 0, F.col("char_start")).otherwise(F.col("char_end")).alias(
            "char_end"
        ),
    )
    return contracts.check_contract(
        "evidence", rows, key=["parsed_document_id", "observation_index"]
    )


@query
def contract_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh page of a document is numbered as if another stood before it."""
    number = F.col("page_number")
    lines = adapters.line_pages(spark, folder).withColumn(
        "page_number", F.when(number == 7, number + 1_000_000).otherwise(number)
    ).select(
        "*",
        F.lit(0).alias("char_start"),
        (F.length("text") - (F.col("page_number") == 3).cast("int")).alias("char_end"),
    )
    return contracts.check_contract("pages", lines)


@query
def contract_runs(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    runs = table(spark, folder, "events").select(
        event.alias("pipeline_run_id"),
        F.when(event % 50 == 0, "dreaming").otherwise("parsed").alias("stage"),
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "view", "running")
        .otherwise("succeeded")
        .alias("status"),
        F.col("ts").alias("started_at"),
        F.when(event % 3 != 0, F.col("ts") - F.expr("INTERVAL 1 SECOND") * (event % 2).cast("int"))
        .alias("finished_at"),
        F.when(event % 5 == 0, "code").alias("error_code"),
        F.when(event % 10 == 0, "message").alias("error_message"),
    )
    return contracts.check_contract("runs", runs)


@query
def contract_observations(spark: SparkSession, folder: str) -> DataFrame:
    index = F.col("observation_index")
    rows = adapters.observations(spark, folder).withColumns(
        {
            "raw_value": F.when(index % 101 == 0, None).otherwise(F.col("raw_value")),
            "field_name": F.when(index % 103 == 0, "colour").otherwise(F.col("field_name")),
            "confidence": F.col("confidence") * 1.2,
        }
    )
    return contracts.check_contract("observations", rows)


@query
def contract_validation(spark: SparkSession, folder: str) -> DataFrame:
    checks = validated(spark, folder).withColumn(
        "status",
        F.when(F.col("observation_index") % 107 == 0, "missing").otherwise(F.col("status")),
    )
    return contracts.check_contract("validation", checks)


@query
def contract_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """Links of a made consistency report per project; some point at nothing or the wrong field."""
    checks = adapters.observations(spark, folder)
    reports = checks.select(
        F.col("project_id").alias("consistency_run_id"), "validation_run_id", "registry", "project_id"
    ).distinct()
    index = F.col("observation_index")
    links = checks.select(
        "validation_run_id",
        F.when(index % 109 == 0, -index - 1).otherwise(index).alias("observation_index"),
        F.lit("cross_version_difference").alias("code"),
        F.when(index % 113 == 0, "country,project_name").otherwise(F.col("field_name")).alias(
            "fields"
        ),
    )
    return contracts.check_contract("consistency", reports, links, checks)


@query
def contract_review(spark: SparkSession, folder: str) -> DataFrame:
    decisions, _, _ = adapters.event_decisions(spark, folder)
    number = F.substring("decision_id", 2, 20).cast("long")
    spoiled = decisions.withColumns(
        {
            "reviewer": F.when(number % 31 == 0, " \t").otherwise(F.col("reviewer")),
            "authority_confirmed": F.when(number % 37 == 0, ~F.col("authority_confirmed")).otherwise(
                F.col("authority_confirmed")
            ),
        }
    )
    return contracts.check_contract("review", spoiled)


@query
def contract_judgments(spark: SparkSession, folder: str) -> DataFrame:
    request = F.col("request_id")
    rows = _judged(spark, folder).select(
        "request_id", "criterion_id", "outcome",
        F.when(request % 41 == 0, "").otherwise("read").alias("reason"),
        F.when(request % 3 == 0, F.array().cast("array<string>"))
        .when(request % 43 == 0, F.array(F.lit("f"), F.lit("f")))
        .otherwise(F.array(F.lit("f")))
        .alias("fact_ids"),
        F.array(F.lit("quote")).alias("evidence"),
    )
    return contracts.check_contract("judgments", rows)


@query
def contract_evaluations(spark: SparkSession, folder: str) -> DataFrame:
    request, dimension = F.col("request_id"), F.col("dimension_id")
    rows = assess.rubric_coverage(_judged(spark, folder)).withColumns(
        {
            "dimension_id": F.when((request % 47 == 0) & (dimension == "D05"), "D99").otherwise(dimension),
            "unreviewed_criterion_ids": F.when(request % 53 == 0, F.col("reviewed_criterion_ids")).otherwise(
                F.col("unreviewed_criterion_ids")
            ),
        }
    )
    return contracts.check_contract("evaluations", rows)


@query
def contract_contexts(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.check_contract("contexts", adapters.project_contexts(spark, folder))


@query
def contract_policies(spark: SparkSession, folder: str) -> DataFrame:
    """Each supplier is a policy; twelve weights that only sometimes add up."""
    key = F.col("s_suppkey")
    weights = table(spark, folder, "supplier").select(
        key.alias("policy_version"),
        F.explode(F.sequence(F.lit(1), F.when(key % 11 == 0, 11).otherwise(12))).alias("n"),
    ).select(
        "policy_version",
        F.concat(F.lit("D"), F.lpad(F.col("n").cast("string"), 2, "0")).alias("dimension_id"),
        F.when((F.col("policy_version") % 7 == 0) & (F.col("n") == 1), None)
        .when(F.col("policy_version") % 3 == 0, F.lit(0.1))
        .otherwise(F.lit(1.0) / 12)
        .alias("weight"),
        F.when(F.col("policy_version") % 2 == 0, "approved").otherwise("draft").alias("status"),
        F.array(F.lit("https://example.org")).alias("authority_sources"),
        F.when(F.col("policy_version") % 5 != 0, "board").alias("approved_by"),
        F.lit("2024-01-01").cast("date").alias("approved_on"),
    )
    return contracts.check_contract("policies", weights)


@query
def contract_gold(spark: SparkSession, folder: str) -> DataFrame:
    number = F.substring("sample_id", 2, 20).cast("long")
    labels = view(spark, folder, adapters.GOLD_LABELS).select(
        "dataset_version", "sample_id", "project_id", "field_name", "label_status", "value_json",
        F.when(number % 61 == 0, "test").otherwise(F.col("split")).alias("split"),
        F.when(number % 59 == 0, "adjudication_required").otherwise(F.col("sample_status")).alias(
            "sample_status"
        ),
        F.when(F.col("value_json").isNotNull(), F.array(F.lit("quote")))
        .otherwise(F.array().cast("array<string>"))
        .alias("evidence"),
        F.lit("read").alias("reason"),
        F.when(number % 67 == 0, F.array(F.lit("ann")))
        .otherwise(F.array(F.lit("ann"), F.lit("bo")))
        .alias("reviewers"),
        F.when(number % 71 != 0, "cy").alias("adjudicator"),
        F.lit("2024-01-01").alias("frozen_at"),
    )
    return contracts.check_contract("gold", labels)


@query
def contract_versions(spark: SparkSession, folder: str) -> DataFrame:
    rows = adapters.arrivals(spark, folder).select(
        F.col("file_name").alias("document_version_id"),
        F.col("registry_project_id").alias("source_document_id"),
        F.when(F.col("byte_size") % 10 == 0, F.upper("sha256")).otherwise(F.col("sha256")).alias(
            "sha256"
        ),
        (F.col("byte_size") - 100).alias("byte_size"),
        "file_name",
        "content_type",
    )
    return contracts.check_contract("versions", rows)


# --------------------------------------------------------------------- tables and streams
@query
def idempotent_append(spark: SparkSession, folder: str) -> DataFrame:
    """A second run of which a third is unchanged, a third changed and a third new."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit("run-1").alias("pipeline_run_id")
    )
    stored = tables.with_result_key(customers.where("c_custkey % 3 != 2"))
    again = customers.withColumn("pipeline_run_id", F.lit("run-2")).withColumn(
        "c_mktsegment",
        F.when(F.col("c_custkey") % 3 == 1, "CHANGED").otherwise(F.col("c_mktsegment")),
    )
    parts = tables.split_by_store(tables.with_result_key(again), stored, ["c_custkey"])
    named = [
        part.select("c_custkey", F.lit(name).alias("result"))
        for part, name in zip(parts, ("written", "reused", "conflict"))
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _thirds(df: DataFrame, time: str) -> list[DataFrame]:
    """The rows before, between and after two moments."""
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = df.select(F.percentile_approx(moment, [0.33, 0.66])).first()[0]
    return [
        df.where(moment < low), df.where((moment >= low) & (moment < high)), df.where(moment >= high)
    ]


def _delivered(spark: SparkSession, parts: list[DataFrame], target: str, start) -> None:
    """Files arrive in turns, as many per turn as the writer makes; each turn the stream catches up."""
    for part in parts:
        part.write.mode("append").parquet(f"{target}/in")
        start(spark.readStream.schema(part.schema).parquet(f"{target}/in")).awaitTermination()


@query
def streamed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All arrivals as a stream of three deliveries; the stored versions at its end."""
    target = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    arrivals = adapters.arrivals(spark, folder)
    _delivered(
        spark, _thirds(arrivals, "retrieved_at"), target,
        lambda stream: jobs.stream_ingest(stream, f"{target}/out", f"{target}/log", buckets=8),
    )
    return jobs.stored_versions(arrivals, f"{target}/out").select(
        "source_document_id", "document_version_id", "sha256"
    )


@query
def streamed_heads(spark: SparkSession, folder: str) -> DataFrame:
    """All decisions as a stream of three deliveries in time order; the heads at its end."""
    target = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    decisions, candidates, verdicts = map(materialize, adapters.event_decisions(spark, folder))
    _delivered(
        spark, _thirds(decisions, "created_at"), target,
        lambda stream: jobs.stream_heads(
            stream, candidates, None, f"{target}/out", f"{target}/log", verdicts, buckets=8
        ),
    )
    return jobs.live_heads(spark, f"{target}/out").select(
        "project_id", "field_name", "fact_id", "value_json"
    )
