"""Catalogs that fix the meaning of results: fields, rules, keywords, dimensions, codes.

Everything in this module is data. Rules can be replaced by passing other lists to the operators.
"""

from __future__ import annotations

from typing import NamedTuple

# ---------------------------------------------------------------------------------------------
# The 55 field names, in catalog order.
FIELDS = (
    "project_id",
    "project_name",
    "country",
    "grid_connection_status",
    "project_boundary_text",
    "technology_type",
    "installed_capacity_mw",
    "renewable_resource_type",
    "baseline_scenario_text",
    "baseline_formula_present",
    "baseline_assumptions_table",
    "ef_value",
    "ef_unit",
    "ef_source_reference",
    "ef_vintage_year",
    "electricity_generated_mwh",
    "electricity_exported_mwh",
    "meter_calibration_status",
    "data_frequency",
    "pe_applicable_flag",
    "pe_value_tco2e",
    "pe_method_text",
    "le_applicable_flag",
    "le_value_tco2e",
    "le_justification_text",
    "be_value_tco2e",
    "er_reported_tco2e",
    "er_recalculated_tco2e",
    "er_recalc_error_pct",
    "additionality_tool_used",
    "investment_analysis_result",
    "barrier_analysis_result",
    "common_practice_result",
    "monitoring_parameters_listed",
    "qa_qc_procedure_text",
    "data_gap_procedure_text",
    "archiving_period_years",
    "validator_name",
    "verifier_name",
    "verification_period_start",
    "verification_period_end",
    "verification_cycle_count",
    "methodology_name",
    "methodology_version",
    "registered_date",
    "listed_date",
    "issuance_cycle_count",
    "version_change_note",
    "project_participant",
    "project_owner",
    "project_developer",
    "project_operator",
    "crediting_period_years",
    "crediting_period_start",
    "crediting_period_end",
)

REGISTRIES = ("acr", "gold_standard", "verra")
DOCUMENT_TYPES = (
    "project_description",
    "monitoring_report",
    "validation_report",
    "verification_report",
    "registry_export",
    "other",
)
STAGES = (
    "discovered",
    "downloaded",
    "hashed",
    "parsed",
    "ocr_required",
    "ocr_parsed",
    "baseline_extracted",
    "llm_extracted",
    "schema_validated",
    "quality_validated",
    "canonicalized",
    "scored",
    "evaluated",
)
EXTRACTION_STAGES = ("baseline_extracted", "llm_extracted")
RUN_STATUSES = ("running", "succeeded", "failed", "skipped")
REPROCESS_STAGES = ("parsed", "extracted", "validated", "reviewed")
SPLITS = ("development", "validation", "test")
MISSING_REASONS = ("not_found", "unsupported_by_baseline", "ambiguous")
OUTCOMES = ("supported", "not_supported", "insufficient", "conflicting", "not_applicable")
METHODOLOGY = "ACM0002"


# ---------------------------------------------------------------------------------------------
class Rule(NamedTuple):
    """One extraction pattern, split so that the value's own position is known."""

    field: str
    prefix: str
    value: str
    suffix: str
    kind: str
    unit: str | None = None
    multiline: bool = False
    # Both only skip pages: lower-case text of which every match holds at least one, and a pattern in
    # the JVM's spelling that every page with a match meets.
    guard: tuple[str, ...] = ()
    hint: str | None = None


_LABEL_SEPARATOR = r"[ \t]*[:\-–][ \t]*"
_REST_OF_LINE = r"[^\n\r]+"
_DATE = (
    r"[A-Za-z]{3,9}\s+\d{1,2},?\s+\d{4}|\d{4}-\d{2}-\d{2}|"
    r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}"
)
_AMOUNT = r"[\d,]+(?:\.\d+)?"
_AMOUNT_FOLLOWS = r"[\s\x1c-\x1f]*[:=]?[\s\x1c-\x1f]*[\d,]"

# The extraction patterns (all case-blind), their value kind and their unit.
EXTRACTION_RULES = (
    Rule(
        "project_name",
        r"^[ \t]*(?:project title|title of project activity|project activity title|"
        r"name of the project activity)" + _LABEL_SEPARATOR,
        _REST_OF_LINE,
        "",
        "title",
        multiline=True,
        guard=("project",),
    ),
    Rule(
        "project_participant",
        r"^[ \t]*(?:project participants?|project proponents?|authorized participants?)"
        + _LABEL_SEPARATOR,
        _REST_OF_LINE,
        "",
        "company",
        multiline=True,
        guard=("participant", "proponent"),
    ),
    Rule(
        "project_owner",
        r"^[ \t]*project owners?" + _LABEL_SEPARATOR,
        _REST_OF_LINE,
        "",
        "company",
        multiline=True,
        guard=("project owner",),
    ),
    Rule(
        "project_developer",
        r"^[ \t]*project developer" + _LABEL_SEPARATOR,
        _REST_OF_LINE,
        "",
        "company",
        multiline=True,
        guard=("project developer",),
    ),
    Rule(
        "project_operator",
        r"^[ \t]*project operator" + _LABEL_SEPARATOR,
        _REST_OF_LINE,
        "",
        "company",
        multiline=True,
        guard=("project operator",),
    ),
    Rule(
        "crediting_period_years",
        r"crediting period(?:\s+of)?\s*[:\-–]?\s*",
        r"\d{1,2}",
        r"\s*years?",
        "integer",
        "years",
        guard=("crediting period",),
    ),
    Rule(
        "crediting_period_start",
        r"(?:start date of crediting period|crediting period start(?: date)?)\s*[:\-–]?\s*",
        _DATE,
        r"(?![\d/-])",
        "date",
        guard=("crediting period",),
    ),
    Rule(
        "crediting_period_end",
        r"(?:end date of crediting period|crediting period end(?: date)?)\s*[:\-–]?\s*",
        _DATE,
        r"(?![\d/-])",
        "date",
        guard=("crediting period",),
    ),
    Rule(
        "country",
        r"(?:host country|project country|country)\s*[:\-]\s*",
        _REST_OF_LINE,
        "",
        "text",
        guard=("country",),
    ),
    Rule(
        "validator_name",
        r"(?:validator|validation body)\s*[:\-]\s*",
        _REST_OF_LINE,
        "",
        "text",
        guard=("validator", "validation body"),
    ),
    Rule(
        "verifier_name",
        r"(?:verifier|verification body|\bvvb)\s*[:\-]\s*",
        _REST_OF_LINE,
        "",
        "text",
        guard=("verifier", "verification body", "vvb"),
    ),
    Rule("methodology_name", r"\b", r"ACM0002", r"\b", "text", guard=("acm0002",)),
    Rule("methodology_name", r"\b", r"AMS-I\.D", r"\b", "text", guard=("ams-i.d",)),
    Rule("methodology_name", r"\b", r"AMS-I\.F", r"\b", "text", guard=("ams-i.f",)),
    Rule("methodology_name", r"\b", r"ACM0006", r"\b", "text", guard=("acm0006",)),
    Rule("methodology_name", r"\b", r"AMS-I\.A", r"\b", "text", guard=("ams-i.a",)),
    Rule("grid_connection_status", "", r"grid[- ]connected", "", "keyword", guard=("connected",)),
    Rule("installed_capacity_mw", "", r"\d+(?:\.\d+)?", r"\s*MW", "number", "MW", guard=("mw",)),
    Rule("er_reported_tco2e", r"(?:ER|Emission Reductions?)\s*[:=]?\s*", _AMOUNT, "", "number", hint=r"(?:er|reductions?)" + _AMOUNT_FOLLOWS),
    Rule("be_value_tco2e", r"(?:BE|Baseline Emissions?)\s*[:=]?\s*", _AMOUNT, "", "number", hint=r"(?:be|emissions?)" + _AMOUNT_FOLLOWS),
    Rule("pe_value_tco2e", r"(?:PE|Project Emissions?)\s*[:=]?\s*", _AMOUNT, "", "number", hint=r"(?:pe|emissions?)" + _AMOUNT_FOLLOWS),
    Rule("le_value_tco2e", r"(?:LE|Leakage)\s*[:=]?\s*", _AMOUNT, "", "number", hint=r"(?:le|leakage)" + _AMOUNT_FOLLOWS),
)
KEYWORD_VALUE = "grid-connected"
TITLE_STOP_PHRASES = (
    r"(?iuUd)\b(?:considered|analysis|common practice|shall|therefore|because)\b"
)

# ---------------------------------------------------------------------------------------------
# Per dimension its name, strong patterns and weak patterns (all case-blind).
KEYWORDS = {
    "D01": (
        "Grid-connected applicability",
        ("grid[- ]connected", "project boundary", "applicability", "eligible"),
        ("boundary", "scope", "grid"),
    ),
    "D02": (
        "Technology eligibility under ACM0002",
        ("wind", "hydro", "solar", "geothermal", "technology"),
        ("renewable", "plant", "capacity"),
    ),
    "D03": (
        "Baseline construction integrity",
        ("baseline scenario", "baseline emissions", "assumptions"),
        ("baseline",),
    ),
    "D04": (
        "Grid emission factor chain",
        ("emission factor", "efgrid", "cdm tool", "tco2"),
        ("grid emission", "factor"),
    ),
    "D05": (
        "Generation/export metering quality",
        ("meter", "calibration", "electricity generated", "mwh"),
        ("generation", "monitoring data"),
    ),
    "D06": (
        "Project emissions (PE) treatment",
        ("project emissions", r"\bpe\b", "pey"),
        ("emissions",),
    ),
    "D07": (
        "Leakage (LE) treatment",
        ("leakage", r"\ble\b", "ley"),
        ("leak",),
    ),
    "D08": (
        "ER formula reproducibility",
        (r"er\s*=\s*be\s*[-−]\s*pe\s*[-−]\s*le", "emission reductions", "ery"),
        (r"\ber\b", r"\bbe\b", r"\bpe\b", r"\ble\b"),
    ),
    "D09": (
        "Additionality robustness",
        ("additionality", "barrier analysis", "investment analysis", "common practice"),
        ("additional",),
    ),
    "D10": (
        "Monitoring architecture completeness",
        ("monitoring plan", "qa/?qc", "data gap", "archiving"),
        ("monitoring", "parameter"),
    ),
    "D11": (
        "Verification reproducibility and cycle consistency",
        ("validation report", "verification report", "vvb", "validator", "verifier"),
        ("verification", "validation"),
    ),
    "D12": (
        "Registry/version transition readiness",
        ("registration", "issuance", "version", "methodology version", "registry"),
        ("registered", "listed", "crediting period"),
    ),
}
MAX_KEYWORD_SCORE = 36
# Plain text that every match of a non-literal pattern holds; only used to skip the regex.
KEYWORD_GUARDS = {
    "grid[- ]connected": "connected",
    "qa/?qc": "qc",
    r"er\s*=\s*be\s*[-−]\s*pe\s*[-−]\s*le": "=",
}

# ---------------------------------------------------------------------------------------------
# The reviewed inputs each dimension needs.
DIMENSION_INPUTS = {
    "D01": ("project_id", "project_name", "grid_connection_status", "project_boundary_text"),
    "D02": ("technology_type", "installed_capacity_mw", "renewable_resource_type"),
    "D03": ("baseline_scenario_text", "baseline_formula_present", "baseline_assumptions_table"),
    "D04": ("ef_value", "ef_unit", "ef_source_reference", "ef_vintage_year"),
    "D05": (
        "electricity_generated_mwh",
        "electricity_exported_mwh",
        "meter_calibration_status",
        "data_frequency",
    ),
    "D06": ("pe_applicable_flag", "pe_value_tco2e", "pe_method_text"),
    "D07": ("le_applicable_flag", "le_value_tco2e", "le_justification_text"),
    "D08": (
        "be_value_tco2e",
        "er_reported_tco2e",
        "er_recalculated_tco2e",
        "er_recalc_error_pct",
    ),
    "D09": (
        "additionality_tool_used",
        "investment_analysis_result",
        "barrier_analysis_result",
        "common_practice_result",
    ),
    "D10": (
        "monitoring_parameters_listed",
        "qa_qc_procedure_text",
        "data_gap_procedure_text",
        "archiving_period_years",
    ),
    "D11": (
        "validator_name",
        "verifier_name",
        "verification_period_start",
        "verification_period_end",
        "verification_cycle_count",
    ),
    "D12": (
        "methodology_name",
        "methodology_version",
        "registered_date",
        "listed_date",
        "issuance_cycle_count",
        "version_change_note",
    ),
}
ER_FIELDS = ("be_value_tco2e", "pe_value_tco2e", "le_value_tco2e", "er_reported_tco2e")
PERIOD_FIELDS = {
    "D05": ("electricity_generated_mwh", "electricity_exported_mwh"),
    "D06": ("pe_value_tco2e",),
    "D07": ("le_value_tco2e",),
    "D08": ER_FIELDS,
}
BINDABLE_FIELDS = (
    "electricity_generated_mwh",
    "electricity_exported_mwh",
    "be_value_tco2e",
    "pe_value_tco2e",
    "le_value_tco2e",
    "er_reported_tco2e",
)
CRITERIA = tuple(f"{dimension}.C{n}" for dimension in DIMENSION_INPUTS for n in (1, 2, 3))

# ---------------------------------------------------------------------------------------------
# Value class of each field and the unit expected for measured fields.
DATE_FIELDS = tuple(f for f in FIELDS if f.endswith(("_start", "_end", "_date")))
INTEGER_FIELDS = (
    "ef_vintage_year",
    "archiving_period_years",
    "verification_cycle_count",
    "issuance_cycle_count",
    "crediting_period_years",
)
BOOLEAN_FIELDS = ("baseline_formula_present", "pe_applicable_flag", "le_applicable_flag")
NUMBER_FIELDS = (
    "installed_capacity_mw",
    "ef_value",
    "electricity_generated_mwh",
    "electricity_exported_mwh",
    "pe_value_tco2e",
    "le_value_tco2e",
    "be_value_tco2e",
    "er_reported_tco2e",
    "er_recalculated_tco2e",
    "er_recalc_error_pct",
)
TEXT_FIELDS = (
    "project_id",
    "project_name",
    "country",
    "grid_connection_status",
    "technology_type",
    "renewable_resource_type",
    "ef_unit",
    "ef_source_reference",
    "data_frequency",
    "validator_name",
    "verifier_name",
    "methodology_name",
    "methodology_version",
    "version_change_note",
    "project_participant",
    "project_owner",
    "project_developer",
    "project_operator",
) + tuple(f for f in FIELDS if f.endswith("_text"))
EXPECTED_UNITS = {
    "installed_capacity_mw": "MW",
    "electricity_generated_mwh": "MWh",
    "electricity_exported_mwh": "MWh",
} | {f: "tCO2e" for f in NUMBER_FIELDS if f.endswith("_tco2e")}

# Issue codes of one candidate in reporting order, with severity and our wording.
ISSUES = {
    "evidence_version_invalid": ("error", "The quote cites a different document version."),
    "evidence_page_invalid": ("error", "The quote cites a page the document does not have."),
    "evidence_quote_missing": ("error", "The quote does not occur on the cited page."),
    "evidence_offsets_missing": ("review", "The quote has no character positions."),
    "evidence_offsets_invalid": ("error", "The text at the stated positions is not the quote."),
    "ambiguous_abstention": ("review", "The extractor left this field open as ambiguous."),
    "field_contract_pending": ("review", "This field has no agreed value type yet."),
    "field_type_invalid": ("error", "The value has the wrong type for this field."),
    "numeric_range_invalid": ("error", "The number lies outside the field's range."),
    "negative_value_requires_domain_rule": ("review", "A negative number needs a field rule."),
    "date_format_unresolved": ("review", "The date is not written as YYYY-MM-DD."),
    "date_calendar_invalid": ("error", "The date is not on the calendar."),
    "unit_unverified": ("review", "The unit is not the expected one; nothing is converted."),
    "confidence_unknown": ("review", "The extractor gave no confidence."),
    "confidence_below_threshold": ("review", "The confidence is below the threshold."),
    "candidate_conflict": ("review", "The extraction holds other values for this field."),
    "semantic_support_pending": ("review", "A reader still has to confirm the meaning."),
}
APPROVAL_TOLERATES = (
    "semantic_support_pending",
    "confidence_unknown",
    "confidence_below_threshold",
)

# Project-level fields whose values must agree, and the paired fields.
PROJECT_FIELDS = (
    "project_id",
    "project_name",
    "country",
    "installed_capacity_mw",
    "technology_type",
    "methodology_name",
    "methodology_version",
    "registered_date",
    "listed_date",
    "project_owner",
    "project_developer",
    "project_operator",
    "project_participant",
    "crediting_period_start",
    "crediting_period_end",
)
DATE_PAIRS = (
    ("crediting_period_start", "crediting_period_end"),
    ("verification_period_start", "verification_period_end"),
)
APPLICABILITY_PAIRS = (
    ("pe_applicable_flag", "pe_value_tco2e"),
    ("le_applicable_flag", "le_value_tco2e"),
)
ENERGY_PAIR = ("electricity_generated_mwh", "electricity_exported_mwh")
CREDITING_PAIR = DATE_PAIRS[0]

# Which issue codes raise a candidate's review priority.
CRITICAL_CODES = (
    "candidate_conflict",
    "evidence_page_invalid",
    "evidence_quote_missing",
    "evidence_version_invalid",
    "evidence_offsets_invalid",
    "field_type_invalid",
    "numeric_range_invalid",
)
HIGH_PREFIXES = ("date_", "evidence_offsets_", "numeric_", "unit_", "field_type_")
NORMAL_CODES = (
    "confidence_below_threshold",
    "confidence_unknown",
    "field_contract_pending",
    "semantic_support_pending",
    "ambiguous_abstention",
)
