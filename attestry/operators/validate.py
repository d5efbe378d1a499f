"""Mechanical validation of candidates: evidence, type, range, date, unit, confidence, conflict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.catalog import (
    BOOLEAN_FIELDS,
    DATE_FIELDS,
    EXPECTED_UNITS,
    INTEGER_FIELDS,
    ISSUES,
    NUMBER_FIELDS,
    TEXT_FIELDS,
)
from attestry.functions.dates import iso_shaped, strict_date
from attestry.functions.text import is_blank
from attestry.functions.values import value_key
from attestry.operators.grounding import ground

CONFIDENCE_THRESHOLD = 0.8
KEY = ("extraction_run_id", "observation_index")

EVIDENCE_CODES = {
    "page_missing": "evidence_page_invalid",
    "quote_missing": "evidence_quote_missing",
    "offsets_missing": "evidence_offsets_missing",
    "offsets_mismatch": "evidence_offsets_invalid",
}


def candidate_conflicts(
    observations: DataFrame, group: Sequence[str] = ("extraction_run_id", "field_name")
) -> DataFrame:
    """Groups that hold more than one distinct value: their smallest and largest keys differ.

    Minimum and maximum combine before the shuffle, so no set of values is ever built.
    """
    return (
        observations.where("missing_reason IS NULL")
        .groupBy(*group)
        .agg(
            F.min(value_key("value_json", "unit")).alias("_low"),
            F.max(value_key("value_json", "unit")).alias("_high"),
        )
        .where("_low != _high")
        .select(*group)
    )


def evidence_issues(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """Evidence issue codes per observation, in evidence order; only observations with issues."""
    spread = observations.select(
        *KEY,
        "parsed_document_id",
        F.col("document_version_id").alias("_version"),
        F.posexplode("evidence").alias("_position", "e"),
    ).select(
        *KEY, "parsed_document_id", "_position", (F.col("e.document_version_id") != F.col("_version")).alias("_foreign"),
        "e.page_number", "e.quote", "e.char_start", "e.char_end",
    )
    code = F.when(F.col("_foreign"), "evidence_version_invalid").otherwise(
        F.element_at(
            F.create_map(*[F.lit(x) for pair in EVIDENCE_CODES.items() for x in pair]),
            F.col("outcome"),
        )
    )
    failed = ground(spread, pages).withColumn("code", code).where("code IS NOT NULL")
    # The list is no longer than the evidence array its row came with.
    ordered = F.array_sort(F.collect_list(F.struct("_position", "code")))
    return failed.groupBy(*KEY).agg(
        F.transform(ordered, lambda item: item["code"]).alias("evidence_codes")
    )


def _value_codes(threshold: float) -> list[Column]:
    field, kind, text = F.col("field_name"), F.col("value_type"), F.col("_string")
    number = F.col("_number")
    is_text = field.isin(*DATE_FIELDS, *TEXT_FIELDS)
    is_measure = field.isin(*INTEGER_FIELDS, *NUMBER_FIELDS)
    typed = (
        F.when(field.isin(*BOOLEAN_FIELDS), kind == "bool")
        .when(field.isin(*INTEGER_FIELDS), kind == "int")
        .when(field.isin(*NUMBER_FIELDS), kind.isin("int", "double"))
        .when(is_text, (kind == "string") & ~is_blank(text))
        .otherwise(True)
    )
    out_of_range = (field.isin(*INTEGER_FIELDS) & (number < 0)) | (
        (field == "installed_capacity_mw") & (number <= 0)
    )
    dated = typed & field.isin(*DATE_FIELDS)
    expected_unit = F.element_at(
        F.create_map(*[F.lit(x) for pair in EXPECTED_UNITS.items() for x in pair]), field
    )
    return [
        F.when(
            ~is_text & ~is_measure & ~field.isin(*BOOLEAN_FIELDS), "field_contract_pending"
        ),
        F.when(~typed, "field_type_invalid"),
        F.when(typed & is_measure & out_of_range, "numeric_range_invalid"),
        F.when(
            typed & is_measure & ~out_of_range & (number < 0),
            "negative_value_requires_domain_rule",
        ),
        F.when(dated & ~iso_shaped(text), "date_format_unresolved"),
        F.when(dated & iso_shaped(text) & strict_date(text).isNull(), "date_calendar_invalid"),
        F.when(
            expected_unit.isNotNull() & ~F.col("unit").eqNullSafe(expected_unit), "unit_unverified"
        ),
        F.when(F.col("confidence").isNull(), "confidence_unknown"),
        F.when(F.col("confidence") < threshold, "confidence_below_threshold"),
        F.when(F.col("_conflict"), "candidate_conflict"),
        F.lit("semantic_support_pending"),
    ]


def _detail(code: Column) -> Column:
    severity = F.create_map(*[F.lit(x) for c, (s, _) in ISSUES.items() for x in (c, s)])
    message = F.create_map(*[F.lit(x) for c, (_, m) in ISSUES.items() for x in (c, m)])
    return F.struct(
        code.alias("code"),
        F.element_at(severity, code).alias("severity"),
        F.element_at(message, code).alias("message"),
    )


ERROR_CODES = tuple(code for code, (severity, _) in ISSUES.items() if severity == "error")


def validate(
    observations: DataFrame, pages: DataFrame, threshold: float = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """Add ``issue_codes``, ``validation_issues`` and ``status`` to every observation.

    Only observations that failed an evidence check, and only those in conflict, come back from the
    two side aggregations, by the same key: observations move once for both joins, and not at all where
    they lie in buckets of ``KEY``.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("confidence threshold must be between zero and one")
    failed = evidence_issues(observations, pages)
    group = ["extraction_run_id", "field_name"]
    # As long as the fields that share an index, which should be one.
    conflicting = (
        observations.where("missing_reason IS NULL").select(*KEY, "field_name")
        .join(candidate_conflicts(observations, group), group, "left_semi")
        .groupBy(*KEY).agg(F.collect_set("field_name").alias("_conflicting"))
    )
    valued = F.col("missing_reason").isNull()
    string = F.when(F.col("value_type") == "string", F.expr("try_variant_get(try_parse_json(value_json), '$', 'string')"))
    checked = (
        observations.join(failed, list(KEY), "left")
        .join(conflicting, list(KEY), "left")
        .withColumns(
            {
                "_conflict": F.coalesce(F.array_contains("_conflicting", F.col("field_name")), F.lit(False)),
                "_string": string,
                "_number": F.when(
                    F.col("value_type").isin("int", "double"),
                    F.expr("try_cast(value_json AS DOUBLE)"),
                ),
            }
        )
    )
    from_value = F.array_compact(F.array(*_value_codes(threshold)))
    from_abstention = F.array_compact(
        F.array(F.when(F.col("missing_reason") == "ambiguous", "ambiguous_abstention"))
    )
    codes = F.concat(
        F.coalesce("evidence_codes", F.array().cast("array<string>")),
        F.when(valued, from_value).otherwise(from_abstention),
    )
    errors = F.array(*[F.lit(code) for code in ERROR_CODES])
    return (
        checked.withColumn("issue_codes", codes)
        .drop("_conflict", "_conflicting", "_string", "_number", "evidence_codes")
        .withColumn("validation_issues", F.transform("issue_codes", _detail))
        .withColumn(
            "status",
            F.when(F.arrays_overlap("issue_codes", errors), "rejected")
            .when(F.size("issue_codes") > 0, "needs_review")
            .otherwise("missing"),
        )
    )


def validation_counts(checks: DataFrame, group: Sequence[str] = ("extraction_run_id",)) -> DataFrame:
    """Missing, rejected and needs-review counts per report."""
    return checks.groupBy(*group).agg(
        *[
            F.count_if(F.col("status") == status).alias(status)
            for status in ("missing", "rejected", "needs_review")
        ]
    )
