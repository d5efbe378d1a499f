"""SQL equivalents of the queries in ``review_queries``."""

from __future__ import annotations

from attestry.catalog import (
    APPROVAL_TOLERATES,
    CRITERIA,
    CRITICAL_CODES,
    DIMENSION_INPUTS,
    ER_FIELDS,
    FIELDS,
    HIGH_PREFIXES,
    NORMAL_CODES,
    PERIOD_FIELDS,
)
from attestry.plans.oracles import (
    ARRIVED,
    ORACLES,
    RECORDED,
    VALIDATED,
    LINES,
    local,
    quoted,
    text_literal,
    uuid5_sql,
)
from attestry.sources import adapters
from attestry.sources.adapters import BOUND, FACT_FIELDS

# --------------------------------------------------------------------------------- import
_TABLES = ", ".join(f"i_{name} AS ({local(sql)})" for name, sql in adapters.IDENTITIES.items())
_RULES = (
    ("extraction_run_status", "xr.status = 'succeeded'"),
    ("input_hash_differs", "xr.input_hash = vr.input_hash"),
    ("registry_differs", "x.registry = r.registry"),
    ("parsed_document_absent", "p.parsed_document_id IS NOT NULL"),
    ("parsed_version_differs", "p.document_version_id = r.document_version_id"),
    ("source_identity_differs", "s.registry = r.registry AND s.registry_project_id = r.project_id"),
    ("validation_input_hash", "vr.input_hash = p.input_hash"),
)
IDENTITY = f"""{_TABLES},
identity AS ({" UNION ALL ".join(
    f'''SELECT r.validation_run_id, '{rule}' AS rule FROM i_reports r
    LEFT JOIN i_extractions x ON x.extraction_run_id = r.extraction_run_id
    LEFT JOIN i_runs xr ON xr.pipeline_run_id = r.extraction_run_id
    LEFT JOIN i_runs vr ON vr.pipeline_run_id = r.validation_run_id
    LEFT JOIN i_parsed p ON p.parsed_document_id = r.parsed_document_id
    LEFT JOIN i_versions v ON v.document_version_id = r.document_version_id
    LEFT JOIN i_sources s ON s.source_document_id = v.source_document_id
    WHERE NOT coalesce({ok}, false)''' for rule, ok in _RULES)})"""
IMPORT = f"""{VALIDATED}, {IDENTITY},
loose AS (SELECT DISTINCT validation_run_id, 'evidence_version_differs' AS rule FROM checks
  WHERE raw_value IS NOT NULL AND evidence_version <> document_version_id),
content AS (SELECT validation_run_id, observation_index, field_name, raw_value, value_json, unit,
    confidence, missing_reason, evidence_version, evidence_page, quote, char_start, char_end, status,
    issue_codes FROM checks),
extracted AS (SELECT * REPLACE (CASE WHEN observation_index % 223 = 0 THEN 'changed' ELSE unit END AS unit,
    CASE WHEN observation_index % 211 = 0 THEN -1 - observation_index ELSE observation_index END
    AS observation_index) FROM content),
differing AS (SELECT DISTINCT validation_run_id, 'observations_differ' AS rule FROM
    ((FROM content EXCEPT FROM extracted) UNION ALL (FROM extracted EXCEPT FROM content))),
earlier AS (SELECT * REPLACE (CASE WHEN observation_index % 227 = 0 THEN 'earlier unit' ELSE unit END
    AS unit) FROM content WHERE CAST(substr(validation_run_id, 2) AS BIGINT) % 4 = 1),
again AS (FROM content WHERE validation_run_id IN (SELECT validation_run_id FROM earlier)),
rewritten AS (SELECT DISTINCT validation_run_id, 'stored_report_differs' AS rule FROM
    ((FROM again EXCEPT FROM earlier) UNION ALL (FROM earlier EXCEPT FROM again))),
earlier_runs AS (SELECT * REPLACE (CASE WHEN CAST(substr(pipeline_run_id, 2) AS BIGINT) % 47 = 0
    THEN 'earlier' ELSE input_hash END AS input_hash) FROM i_runs),
changed_runs AS (FROM i_runs EXCEPT FROM earlier_runs),
rerun AS (SELECT DISTINCT validation_run_id, 'stored_run_differs' AS rule FROM i_reports
  WHERE validation_run_id IN (SELECT pipeline_run_id FROM changed_runs)
    OR extraction_run_id IN (SELECT pipeline_run_id FROM changed_runs)),
violations AS (SELECT * FROM identity UNION ALL SELECT * FROM loose UNION ALL SELECT * FROM differing
  UNION ALL SELECT * FROM rewritten UNION ALL SELECT * FROM rerun),
clean AS (SELECT *, {uuid5_sql("'candidate:' || validation_run_id || ':' || observation_index")}
    AS candidate_id FROM checks
  WHERE validation_run_id NOT IN (SELECT validation_run_id FROM violations)
    AND validation_run_id NOT IN (SELECT validation_run_id FROM earlier))"""
ORACLES["import_violations"] = f"WITH {IMPORT} SELECT * FROM violations"
ORACLES["imported_candidates"] = f"""
WITH {IMPORT} SELECT candidate_id, validation_run_id, observation_index, field_name,
  status AS validation_status FROM clean
"""
ORACLES["imported_evidence"] = f"""
WITH {IMPORT} SELECT candidate_id, 0 AS evidence_index, evidence_page AS page_number, quote,
  char_start FROM clean WHERE raw_value IS NOT NULL
"""
ORACLES["observation_mismatches"] = f"WITH {IMPORT} SELECT * FROM differing"

# ------------------------------------------------------------------------------ canonical
_LAST = f"last_value(likely_head IGNORE NULLS) OVER {adapters.WINDOW_BEFORE}"
_HEADS = range(6)
_STEP = ", ".join(
    f"CASE WHEN f = {n} AND code = '' AND status = 'approved' THEN own ELSE h{n} END AS h{n}, "
    f"CASE WHEN f = {n} AND code = '' AND status = 'approved' THEN value_json ELSE v{n} END AS v{n}"
    for n in _HEADS
)
_EMPTY = ", ".join(f"NULL::VARCHAR AS h{n}, NULL::VARCHAR AS v{n}" for n in _HEADS)
FOLD = f"""RECURSIVE d AS (SELECT *, event_id % 6 AS f,
    {uuid5_sql("'fact:' || decision_id")} AS own,
    CASE WHEN prior_decision IS NOT NULL THEN {uuid5_sql("'fact:' || prior_decision")} END AS expected,
    row_number() OVER (PARTITION BY project_id ORDER BY created_at, decision_id) AS n
  FROM ({local(adapters.EXPECTING).replace("LAST_BEFORE", _LAST)})),
fold AS (SELECT DISTINCT project_id, 0::BIGINT AS n, NULL::VARCHAR AS decision_id,
    NULL::VARCHAR AS status, NULL::VARCHAR AS field_name, NULL::VARCHAR AS value_json, ''::VARCHAR AS code,
    NULL::VARCHAR AS own, NULL::VARCHAR AS before_value_json, NULL::VARCHAR AS expected, {_EMPTY} FROM d
  UNION ALL
  SELECT project_id, n, decision_id, status, field_name, value_json, code, own, before_value_json,
    expected, {_STEP}
  FROM (SELECT *, CASE WHEN head IS DISTINCT FROM expected THEN 'stale_current_fact'
      WHEN status = 'approved' AND blocked_code IS NOT NULL THEN blocked_code
      WHEN status = 'approved' AND f = 4 AND value_json > v5 THEN 'date_order_reversed'
      WHEN status = 'approved' AND f = 5 AND v4 > value_json THEN 'date_order_reversed'
      ELSE '' END AS code
    FROM (SELECT d.project_id, d.n, d.decision_id, d.status, d.field_name, d.value_json, d.own, d.expected,
        d.f, d.blocked_code, {", ".join(f"h{n}, v{n}" for n in _HEADS)},
        CASE d.f {" ".join(f"WHEN {n} THEN h{n}" for n in _HEADS)} END AS head,
        CASE d.f {" ".join(f"WHEN {n} THEN v{n}" for n in _HEADS)} END AS before_value_json
      FROM fold JOIN d ON d.project_id = fold.project_id AND d.n = fold.n + 1))),
decided AS (SELECT *, status = 'approved' AND code = '' AS wrote FROM fold WHERE n > 0)"""
# The value a decision would replace is that of the fact it expects, wherever that fact was written.
ORACLES["decision_outcomes"] = f"""
WITH {FOLD} SELECT a.decision_id, CASE WHEN a.code = '' THEN a.status ELSE 'blocked' END AS outcome,
  a.code AS codes, CASE WHEN a.wrote THEN a.own END AS fact_id, b.value_json AS before_value_json,
  CASE WHEN a.status = 'approved' THEN a.value_json END AS after_value_json
FROM decided a LEFT JOIN decided b ON b.own = a.expected AND b.wrote
"""
ORACLES["canonical_facts"] = f"""
WITH {FOLD} SELECT own AS fact_id, decision_id, project_id, field_name, value_json
FROM decided WHERE wrote
"""
ORACLES["canonical_heads"] = f"""
WITH {FOLD} SELECT project_id, field_name, own AS fact_id, value_json FROM decided WHERE wrote
QUALIFY row_number() OVER (PARTITION BY project_id, field_name ORDER BY n DESC) = 1
"""
_BARRED = f"""array_to_string(list_filter(string_split(issue_codes, ','), lambda c: c NOT IN
  ({quoted((*APPROVAL_TOLERATES, "candidate_conflict"))})), ',')"""
ORACLES["replacement_verdicts"] = f"""
WITH {VALIDATED} SELECT validation_run_id || ':' || observation_index AS decision_id,
  {_BARRED} AS blocked_codes FROM checks WHERE raw_value IS NOT NULL
"""

# --------------------------------------------------------------------------------- review
_CRITICAL = " OR ".join(f"list_contains(c, '{code}')" for code in CRITICAL_CODES)
_NORMAL = " OR ".join(f"list_contains(c, '{code}')" for code in NORMAL_CODES)
_HIGH = text_literal("^(" + "|".join(HIGH_PREFIXES) + ")")
QUEUE = f"""candidates AS (SELECT *, string_split(codes, ',') AS c
  FROM ({local(adapters.REVIEW_CANDIDATES)})),
log AS ({local(adapters.REVIEW_DECISIONS)}),
latest AS (SELECT candidate_id, arg_max(status, (created_at, decision_id)) AS state,
    count(*) AS n FROM log GROUP BY 1),
heads AS (SELECT project_id, field_name, 'F' || arg_max(decision_id, (created_at, decision_id))
    AS fact_id FROM log WHERE status = 'approved' GROUP BY 1, 2),
flagged AS (SELECT a.*, coalesce(l.state, 'pending') AS review_state, coalesce(l.n, 0) AS decision_count,
    h.fact_id AS current_fact_id, CASE WHEN validation_status <> 'missing' THEN 1 ELSE 0 END AS evidence_count,
    ({_CRITICAL}) AS critical, len(list_filter(c, lambda x: regexp_matches(x, {_HIGH}))) > 0 AS high,
    ({_NORMAL}) AS normal
  FROM candidates a LEFT JOIN latest l ON l.candidate_id = a.candidate_id
  LEFT JOIN heads h ON h.project_id = a.project_id AND h.field_name = a.field_name),
items AS (SELECT *, CASE WHEN critical OR validation_status <> 'needs_review' THEN 'critical'
      WHEN high THEN 'high' WHEN normal THEN 'normal' ELSE 'low' END AS priority,
    CASE WHEN critical OR validation_status <> 'needs_review' THEN 100
      WHEN high THEN 70 WHEN normal THEN 40 ELSE 20 END AS priority_score,
    CASE WHEN NOT critical AND NOT high AND NOT normal AND validation_status = 'needs_review'
      THEN 'manual_review_required' ELSE concat_ws(',',
        CASE validation_status WHEN 'rejected' THEN 'mechanical_rejection'
          WHEN 'missing' THEN 'missing_candidate_value' END,
        CASE WHEN critical THEN 'critical_validation_issue' END,
        CASE WHEN high THEN 'high_risk_validation_issue' END,
        CASE WHEN normal THEN 'human_semantic_review' END) END AS priority_reasons FROM flagged)"""
_SHOWN = """candidate_id, review_state, priority, priority_score, priority_reasons, decision_count,
  current_fact_id, evidence_count"""
ORACLES["review_queue"] = f"WITH {QUEUE} SELECT {_SHOWN} FROM items WHERE review_state <> 'approved'"
ORACLES["review_queue_all_states"] = f"WITH {QUEUE} SELECT {_SHOWN} FROM items"
ORACLES["review_queue_top"] = f"""
WITH {QUEUE} SELECT {_SHOWN} FROM items WHERE field_name = 'country'
ORDER BY priority_score DESC, project_id, field_name, observation_index, candidate_id LIMIT 50
"""
ORACLES["review_queue_counts"] = f"""
WITH {QUEUE} SELECT 'review_state' AS dimension, review_state AS value, count(*) AS items
FROM items WHERE review_state <> 'approved' GROUP BY 2 UNION ALL
SELECT 'priority', priority, count(*) FROM items WHERE review_state <> 'approved' GROUP BY 2
"""
ORACLES["latest_decisions"] = f"""
WITH {QUEUE} SELECT candidate_id, state AS review_state, n AS decision_count FROM latest
"""
ORACLES["candidate_listing"] = f"""
WITH {QUEUE} SELECT validation_run_id, observation_index, candidate_id,
  current_fact_id AS expected_current_fact_id FROM items
"""
ORACLES["review_metrics"] = f"""
WITH {QUEUE}, runs AS ({local(adapters.REVIEW_RUNS)}),
delays AS (SELECT epoch_us(l.created_at) - epoch_us(r.finished_at) AS us
  FROM log l JOIN candidates c ON c.candidate_id = l.candidate_id
  JOIN runs r ON r.pipeline_run_id = c.validation_run_id)
SELECT count(*) AS total_candidates,
  count(*) FILTER (validation_status = 'missing') AS candidates_missing,
  count(*) FILTER (validation_status = 'rejected') AS candidates_rejected,
  count(*) FILTER (validation_status = 'needs_review') AS candidates_needs_review,
  count(*) FILTER (decision_count > 0) AS reviewed_candidates,
  count(*) FILTER (review_state <> 'approved') AS pending_candidates,
  sum(decision_count) AS decisions,
  (SELECT count(*) FROM log WHERE status = 'approved') AS decisions_approved,
  (SELECT count(*) FROM log WHERE status = 'rejected') AS decisions_rejected,
  (SELECT count(*) FROM log WHERE status = 'unresolved') AS decisions_unresolved,
  count(*) FILTER (decision_count > 1) AS rework_candidate_count,
  (SELECT count(*) FILTER (status = 'approved') / count(*) FROM log) AS approval_rate,
  (SELECT count(*) FILTER (status = 'unresolved') / count(*) FROM log) AS unresolved_rate,
  sum(evidence_count) / count(*) AS evidence_coverage,
  count(DISTINCT field_name) FILTER (decision_count > 0) / count(DISTINCT field_name)
    AS field_coverage,
  (SELECT sum(us) / count(*) / 1e6 FROM delays WHERE us >= 0) AS average_review_latency_seconds
FROM items
"""

# ----------------------------------------------------------------------------- assessment
PROVENANCE = f"""{_TABLES}, recorded AS ({RECORDED}),
facts AS (SELECT registry, project_id, field_name,
    min((validation_run_id, observation_index, value_json, unit)) AS o
  FROM recorded WHERE raw_value IS NOT NULL GROUP BY 1, 2, 3),
named AS (SELECT registry, project_id, field_name, o[1] AS validation_run_id,
    o[2] AS observation_index, 'f:' || o[1] || ':' || o[2] AS fact_id, o[2] % 29 AS odd FROM facts),
chain AS (SELECT n.*, r.extraction_run_id, p.document_version_id, v.source_document_id, v.sha256,
    s.source_url
  FROM named n JOIN i_reports r USING (validation_run_id)
  JOIN i_parsed p ON p.parsed_document_id = r.parsed_document_id
  JOIN i_versions v ON v.document_version_id = p.document_version_id
  JOIN i_sources s ON s.source_document_id = v.source_document_id)"""
ORACLES["fact_provenance"] = f"""
WITH {PROVENANCE} SELECT registry, project_id, field_name, fact_id, extraction_run_id,
  document_version_id, source_document_id, sha256, source_url FROM chain WHERE odd NOT IN (1, 2)
"""
ORACLES["provenance_violations"] = f"""
WITH {PROVENANCE} SELECT registry, project_id, field_name, fact_id,
  'canonical_provenance_mismatch' AS rule FROM chain WHERE odd IN (1, 2)
"""
_INPUTS = ", ".join(
    f"('{d}', {n}, '{f}')" for d, fields in DIMENSION_INPUTS.items() for n, f in enumerate(fields)
)


def readiness_sql(where: str = "true") -> str:
    return f"""facts AS (SELECT * FROM ({local(adapters.PROJECT_FACTS)}) WHERE {where}),
inputs(dimension_id, n, field_name) AS (VALUES {_INPUTS}),
projects AS (SELECT project_id, bool_or(field_name = 'methodology_name'
    AND value_json = '"ACM0002"') AS scope FROM facts GROUP BY 1
  UNION ALL SELECT 'S' || s_suppkey, false FROM supplier),
ready AS (SELECT p.project_id, i.dimension_id,
    coalesce(string_agg(i.field_name, ',' ORDER BY i.n) FILTER (f.fact_id IS NOT NULL), '')
      AS available_fields,
    coalesce(string_agg(i.field_name, ',' ORDER BY i.n) FILTER (f.fact_id IS NULL), '')
      AS missing_fields,
    coalesce(string_agg(f.fact_id, ',' ORDER BY i.n) FILTER (f.fact_id IS NOT NULL), '') AS fact_ids,
    CASE WHEN any_value(p.scope) THEN 'confirmed_by_reviewed_fact' ELSE 'unconfirmed_or_out_of_scope' END
      AS methodology_scope
  FROM projects p CROSS JOIN inputs i LEFT JOIN facts f ON f.project_id = p.project_id
    AND f.field_name = i.field_name GROUP BY 1, 2)"""


ORACLES["readiness"] = f"""
WITH {readiness_sql()} SELECT *, CASE WHEN missing_fields = '' THEN 'rubric_pending'
  ELSE 'missing_inputs' END AS status FROM ready
"""
ORACLES["stale_readiness"] = f"""
WITH {readiness_sql()} SELECT 'verra' AS registry, project_id, 'D12' AS dimension_id,
  'stale_readiness' AS rule FROM facts WHERE c_custkey % 19 = 0
  AND field_name = 'methodology_version'
"""


def _present(n: int) -> str:
    return f"(c_custkey + {n}) % 23 <> 0"


_N = {field: n for n, field in enumerate(FACT_FIELDS)}
_CTX = "c_custkey % 4 <> 0"
_IDS = [("methodology_name", f"{_CTX} AND (c_custkey % 10 = 0 OR NOT {_present(17)})"),
        ("methodology_version", f"{_CTX} AND NOT {_present(18)}")]
for _field in sorted(BOUND):
    _wrong = f"NOT {_present(_N[_field])}"
    if _field == "pe_value_tco2e":
        _wrong = f"({_wrong} OR c_custkey % 15 = 0)"
    if _field == "le_value_tco2e":
        _wrong = f"({_wrong} AND c_custkey % 14 <> 0)"
    _IDS.append((_field, f"{_CTX} AND {_wrong}"))
_MISMATCHES = ", ".join(
    f"CASE WHEN {condition} THEN 'context_fact_identity_mismatch:{field}' END"
    for field, condition in _IDS
)
# A context without facts: every fact that it binds differs.
_LOST = ", ".join(
    f"CASE WHEN {'c_custkey % 14 <> 0' if field == 'le_value_tco2e' else 'true'} "
    f"THEN 'context_fact_identity_mismatch:{field}' END"
    for field in ("methodology_name", "methodology_version", *sorted(BOUND))
)
_DOCUMENT = "(SELECT count(*) FROM facts f WHERE f.c_custkey = customer.c_custkey) > 0"
GATED = f"""facts AS ({local(adapters.PROJECT_FACTS)}),
gated AS (SELECT 'P' || c_custkey AS project_id, c_custkey, concat_ws(',',
    CASE WHEN c_custkey % 9 = 0 OR NOT {_present(17)} THEN 'methodology_scope_unconfirmed' END,
    CASE WHEN c_custkey % 13 = 0 OR NOT {_present(18)} THEN 'methodology_version_missing' END,
    CASE WHEN NOT ({_CTX}) THEN 'assessment_context_missing' END,
    CASE WHEN {_CTX} AND c_custkey % 6 = 0 THEN 'authority_not_confirmed' END,
    {_MISMATCHES},
    CASE WHEN {_CTX} AND (c_custkey % 21 = 0) THEN 'context_evidence_not_grounded' END) AS gates,
    {_CTX} AS given
  FROM customer WHERE {_DOCUMENT}
  UNION ALL SELECT 'Q' || c_custkey, c_custkey, concat_ws(',', 'methodology_scope_unconfirmed',
    'methodology_version_missing', CASE WHEN c_custkey % 6 = 0 THEN 'authority_not_confirmed' END,
    {_LOST}, 'context_evidence_not_grounded'), true
  FROM customer WHERE NOT ({_CTX}))"""
ORACLES["business_gates"] = f"WITH {GATED} SELECT project_id, gates FROM gated"
_PERIODS = ", ".join(
    f"('{d}', {n}, '{f}')" for d, fields in PERIOD_FIELDS.items() for n, f in enumerate(fields)
)
ORACLES["dimension_checks"] = f"""
WITH {GATED}, inputs(dimension_id, n, field_name) AS (VALUES {_INPUTS}),
periods(dimension_id, n, field_name) AS (VALUES {_PERIODS}),
missing AS (SELECT g.project_id, g.c_custkey, g.gates, i.dimension_id,
    coalesce(string_agg(i.field_name, ',' ORDER BY i.n) FILTER (f.fact_id IS NULL), '')
      AS missing_fields
  FROM gated g CROSS JOIN inputs i LEFT JOIN facts f ON f.project_id = g.project_id
    AND f.field_name = i.field_name GROUP BY ALL),
bound AS (SELECT g.project_id, p.dimension_id,
    coalesce(string_agg(p.field_name, ',' ORDER BY p.n) FILTER (NOT g.given
      OR p.field_name = 'le_value_tco2e' AND g.c_custkey % 14 = 0), '') AS binding
  FROM gated g CROSS JOIN periods p GROUP BY ALL)
SELECT m.project_id, m.dimension_id, m.missing_fields,
  coalesce(b.binding, '') AS period_binding_missing,
  CASE WHEN m.gates <> '' OR m.missing_fields <> '' OR coalesce(b.binding, '') <> '' THEN 'blocked'
    ELSE 'inputs_checked' END AS deterministic_status
FROM missing m LEFT JOIN bound b USING (project_id, dimension_id)
"""
_ALL_ER = " AND ".join(_present(_N[f]) for f in ER_FIELDS)
ORACLES["er_diagnostic"] = f"""
WITH {GATED}, amounts AS (SELECT *, gates = '' AND c_custkey % 14 <> 0 AND {_ALL_ER} AS open,
    c_custkey % 17 <> 0 AS tonnes, (1000 + c_custkey % 50)::DOUBLE
      - (c_custkey % 10 + 0.5) - 5 AS calculated,
    CASE WHEN c_custkey % 31 = 0 THEN 0 ELSE 990 + c_custkey % 37 END::DOUBLE AS reported
  FROM gated), stated AS (SELECT *, open AND tonnes AS computed FROM amounts)
SELECT project_id, CASE WHEN computed THEN 'computed' ELSE 'blocked' END AS er_status,
  CASE WHEN computed THEN calculated END AS recalculated,
  CASE WHEN computed THEN reported - calculated END AS reported_minus_recalculated,
  CASE WHEN computed AND reported <> 0 THEN round(abs(reported - calculated) / reported * 100, 6)
    END AS absolute_error_pct,
  CASE WHEN open AND NOT tonnes THEN 'numeric_values_and_units_required'
    WHEN NOT open THEN 'scoped_inputs_not_confirmed' WHEN reported = 0 THEN 'zero_reported_value'
    ELSE 'arithmetic_only' END AS reason
FROM stated
"""
JUDGED = f"""judged AS (SELECT *, {adapters.JUDGMENT_OUTCOME} AS outcome
  FROM ({local(adapters.JUDGED)})),
criteria(criterion_id) AS (VALUES {", ".join(f"('{c}')" for c in CRITERIA)}),
coverage AS (SELECT r.request_id, substr(c.criterion_id, 1, 3) AS dimension_id,
    coalesce(string_agg(c.criterion_id, ',' ORDER BY c.criterion_id)
      FILTER (j.outcome IS NOT NULL), '') AS reviewed_criterion_ids,
    coalesce(string_agg(c.criterion_id, ',' ORDER BY c.criterion_id)
      FILTER (j.outcome IS NULL), '') AS unreviewed_criterion_ids,
    coalesce(bool_or(j.outcome IN ('insufficient', 'conflicting')), false) AS unresolved
  FROM (SELECT DISTINCT request_id FROM judged) r CROSS JOIN criteria c
  LEFT JOIN judged j ON j.request_id = r.request_id AND j.criterion_id = c.criterion_id
  GROUP BY 1, 2)"""
ORACLES["rubric_coverage"] = f"""
WITH {JUDGED} SELECT request_id, dimension_id, reviewed_criterion_ids, unreviewed_criterion_ids,
  CASE WHEN reviewed_criterion_ids = '' THEN 'unreviewed'
    WHEN unreviewed_criterion_ids <> '' THEN 'partially_reviewed' WHEN unresolved THEN 'unresolved'
    ELSE 'reviewed_pending_policy' END AS status FROM coverage
"""
_ALLOWED = ", ".join(
    f"('{d}', '{f}')"
    for d, fields in DIMENSION_INPUTS.items()
    for f in sorted(
        {*fields, "methodology_name", "methodology_version"}
        | ({"pe_value_tco2e", "le_value_tco2e"} if d == "D08" else set())
    )
)
_CRITERION = f"(ARRAY[{quoted((*CRITERIA, 'D00.C0'))}])[o_orderkey % 37 + 1]"
ORACLES["judgment_violations"] = f"""
WITH facts AS ({local(adapters.PROJECT_FACTS)}), allowed(dimension_id, field_name) AS (VALUES {_ALLOWED}),
judged AS (SELECT o_orderkey AS request_id, {_CRITERION} AS criterion_id,
    'F' || o_custkey || '-' || (o_orderkey % 19) AS fact_id, o_orderkey % 5 = 0 AS invented
  FROM orders),
scoped AS (SELECT j.*, a.field_name IS NOT NULL AS inside FROM judged j
  LEFT JOIN facts f ON f.fact_id = j.fact_id
  LEFT JOIN allowed a ON a.dimension_id = substr(j.criterion_id, 1, 3)
    AND a.field_name = f.field_name)
SELECT request_id, criterion_id, 'unknown_criterion' AS rule FROM scoped WHERE criterion_id = 'D00.C0'
UNION ALL SELECT request_id, criterion_id, 'fact_out_of_scope' FROM scoped
WHERE criterion_id <> 'D00.C0' AND NOT inside
UNION ALL SELECT request_id, criterion_id, 'judgment_not_grounded' FROM scoped
WHERE criterion_id <> 'D00.C0' AND (NOT inside OR invented)
"""

# ----------------------------------------------------------------------------- evaluation
COMPARED = f"""recorded AS ({RECORDED}),
valued AS (SELECT extraction_run_id, field_name, value_json || '|' || coalesce('u' || unit, '-') AS k,
    CASE WHEN observation_index % 1000 % 3 = 2 AND observation_index % 5 = 0 THEN value_json || '|uother'
      ELSE value_json || '|' || coalesce('u' || unit, '-') END AS l,
    observation_index % 1000 % 3 AS odd FROM recorded WHERE raw_value IS NOT NULL),
sets AS (SELECT extraction_run_id, field_name,
    string_agg(DISTINCT l, ';' ORDER BY l) FILTER (odd <> 0) AS a,
    string_agg(DISTINCT k, ';' ORDER BY k) FILTER (odd <> 1) AS b,
    count(DISTINCT l) FILTER (odd <> 0) AS na, count(DISTINCT k) FILTER (odd <> 1) AS nb
  FROM valued GROUP BY 1, 2),
compared AS (SELECT r.extraction_run_id, r.field_name,
    CASE WHEN a IS NULL AND b IS NULL THEN 'both_missing' WHEN a IS NULL THEN 'llm_only'
      WHEN b IS NULL THEN 'regex_only' WHEN a = b THEN 'same_values' ELSE 'different_values' END
      AS outcome, coalesce(na, 0) > 1 AS regex_conflict, coalesce(nb, 0) > 1 AS llm_conflict
  FROM (SELECT DISTINCT extraction_run_id, field_name FROM recorded) r
  LEFT JOIN sets USING (extraction_run_id, field_name))"""
ORACLES["extractor_comparison"] = f"WITH {COMPARED} SELECT * FROM compared"
ORACLES["comparison_counts"] = f"""
WITH {COMPARED} SELECT extraction_run_id, {", ".join(
    f"count(*) FILTER (outcome = '{o}') AS {o}" for o in
    ("both_missing", "llm_only", "regex_only", "same_values", "different_values"))}
FROM compared GROUP BY 1
"""
GOLD = f"""labels AS ({local(adapters.GOLD_LABELS)}),
seen AS (SELECT extraction_run_id, field_name, count(*) AS n, count(raw_value) AS valued,
    min(value_json || '|' || coalesce('u' || unit, '-')) AS k
  FROM ({RECORDED}) GROUP BY 1, 2),
gold AS (SELECT l.*, s.n AS candidate_count, s.n - s.valued AS candidate_missing_count,
    s.valued > 0 AS evidence_present,
    CASE WHEN label_status = 'unknown'
        THEN CASE WHEN valued = 0 THEN 'correct_abstention' ELSE 'unsupported_value' END
      WHEN valued > 1 THEN 'conflicting_candidates' WHEN valued = 0 THEN 'missing_or_abstained'
      WHEN k = l.value_json || '|' || coalesce('u' || l.unit, '-') THEN 'exact_match'
      ELSE 'value_mismatch' END AS outcome
  FROM labels l JOIN seen s USING (extraction_run_id, field_name) WHERE sample_status = 'frozen')"""
_COVERED = """samples AS (SELECT DISTINCT dataset_version, split, sample_id,
  CAST(substr(sample_id, 2) AS BIGINT) AS n FROM gold WHERE dataset_version <> 'acr'),
written AS (SELECT *, CASE WHEN n % 45 = 0 THEN 'Q' ELSE '' END || sample_id AS report FROM samples),
reports AS (SELECT dataset_version, split, report, CASE WHEN n % 77 = 0 THEN 2 ELSE 1 END AS times FROM written
  UNION ALL SELECT dataset_version, split, 'Z' || report, 1 FROM written WHERE n % 99 = 0),
coverage AS (
  SELECT s.dataset_version, s.split, s.sample_id, 'missing_report' AS rule FROM samples s
  ANTI JOIN reports r ON r.dataset_version = s.dataset_version AND r.report = s.sample_id
  UNION ALL SELECT r.dataset_version, r.split, r.report, 'unexpected_report' FROM reports r
  ANTI JOIN samples s ON r.dataset_version = s.dataset_version AND r.report = s.sample_id
  UNION ALL SELECT dataset_version, split, report, 'duplicate_report' FROM reports WHERE times > 1)"""
_METRICS = """count(*) AS evaluated_fields,
  count(*) FILTER (outcome IN ('exact_match', 'correct_abstention')) AS agreement_count,
  count(*) FILTER (outcome IN ('exact_match', 'correct_abstention')) / count(*) AS accuracy,
  count(*) FILTER (label_status = 'confirmed') AS confirmed_fields,
  count(*) FILTER (outcome = 'exact_match') / nullif(count(*) FILTER (label_status = 'confirmed'), 0)
    AS confirmed_accuracy,
  count(*) FILTER (label_status = 'unknown') AS unknown_fields,
  count(*) FILTER (outcome = 'correct_abstention')
    / nullif(count(*) FILTER (label_status = 'unknown'), 0) AS unknown_abstention_rate"""
ORACLES["gold_rows"] = f"""
WITH {GOLD} SELECT dataset_version, sample_id, split, field_name, label_status, outcome,
  candidate_count, candidate_missing_count, evidence_present FROM gold
"""
ORACLES["gold_sample_metrics"] = f"""
WITH {GOLD} SELECT dataset_version, sample_id, split, {_METRICS},
  count(*) FILTER (evidence_present) / count(*) AS evidence_coverage FROM gold GROUP BY 1, 2, 3
"""
ORACLES["gold_coverage_violations"] = f"""
WITH {GOLD}, {_COVERED} SELECT * FROM coverage
"""
_AGGREGATE = f"""SELECT dataset_version, coalesce(split, 'all') AS split,
  count(DISTINCT sample_id) AS samples_evaluated, {_METRICS}
  FROM gold GROUP BY GROUPING SETS ((dataset_version, split), (dataset_version))"""
ORACLES["gold_aggregate"] = f"WITH {GOLD} {_AGGREGATE}"
ORACLES["gold_aggregate_complete"] = f"""
WITH {GOLD}, {_COVERED}, open AS (SELECT dataset_version, split FROM coverage
  UNION SELECT dataset_version, 'all' FROM coverage)
SELECT a.* FROM ({_AGGREGATE}) a ANTI JOIN open o
  ON o.dataset_version = a.dataset_version AND o.split = a.split
"""
ORACLES["gold_violations"] = f"""
WITH labels AS (SELECT DISTINCT dataset_version, sample_id, sample_status,
  CAST(substr(sample_id, 2) AS BIGINT) AS n FROM ({local(adapters.GOLD_LABELS)}))
SELECT dataset_version, sample_id, 'draft_sample' AS rule FROM labels WHERE sample_status <> 'frozen'
UNION ALL SELECT dataset_version, sample_id, 'project_id_differs' FROM labels WHERE n % 29 = 0
"""
ORACLES["gold_acceptance"] = f"""
WITH {GOLD}, {_COVERED}, test AS (SELECT dataset_version, {_METRICS},
    count(*) FILTER (outcome = 'conflicting_candidates') / count(*) AS conflict_rate
  FROM gold WHERE split = 'test' GROUP BY 1),
gates AS (SELECT dataset_version, CASE dataset_version
    WHEN 'gold_standard' THEN 'approved_policy_required' WHEN 'verra' THEN 'frozen_gold_required'
    ELSE CASE WHEN EXISTS (SELECT 1 FROM coverage c WHERE c.dataset_version = d.dataset_version
      AND c.split = 'test') THEN 'incomplete_reports' END
    END AS gate FROM (SELECT DISTINCT dataset_version FROM labels) d)
SELECT g.dataset_version, 'policy-' || g.dataset_version AS policy_version,
  coalesce(gate, CASE WHEN accuracy IS NULL THEN 'incomplete_reports' END, 'accepted') AS gate,
  CASE WHEN gate IS NULL THEN accuracy END AS accuracy,
  CASE WHEN gate IS NULL THEN confirmed_accuracy END AS confirmed_accuracy,
  CASE WHEN gate IS NULL THEN unknown_abstention_rate END AS unknown_abstention_rate,
  CASE WHEN gate IS NULL THEN conflict_rate END AS conflict_rate
FROM gates g LEFT JOIN test t USING (dataset_version)
"""

# -------------------------------------------------------------------------------- replies
SELECTED = f"""recorded AS ({RECORDED}),
orders_pages AS (SELECT l_orderkey AS request_id, count(*) AS page_count,
    sum(length(text)) AS character_count, list(page_number ORDER BY page_number) AS p
  FROM recorded GROUP BY 1),
selected AS (SELECT request_id, page_count, character_count,
    CASE WHEN request_id % 11 = 0 THEN 'not_unique'
      WHEN request_id % 13 = 0 THEN 'page_outside_document'
      WHEN page_count > 4 THEN 'page_budget_exceeded'
      WHEN character_count > 900 THEN 'character_budget_exceeded' ELSE 'ok' END AS status
  FROM orders_pages)"""
ORACLES["page_selection"] = f"WITH {SELECTED} SELECT * FROM selected"
ORACLES["selected_pages_hash"] = f"""
WITH {SELECTED} SELECT request_id, sha256('[' || string_agg('{{"page_number":' || page_number
  || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}}', ',' ORDER BY page_number) || ']')
  AS selected_pages_hash
FROM selected JOIN recorded ON l_orderkey = request_id WHERE status = 'ok' GROUP BY 1
"""
_COST = "(octet_length(encode(text)) * 15 + (doc_id % 1000) * 60) / 100000000"
ORACLES["call_costs"] = f"""
SELECT doc_id, octet_length(encode(text)) AS input_tokens, doc_id % 1000 AS output_tokens,
  {_COST} AS estimated_cost_usd, {_COST} <= 0.0005 AS within_ceiling FROM documents
"""
ORACLES["pending_requests"] = """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS document_version_id FROM documents WHERE doc_id % 6 <> 0
"""
REPLIED = f"""recorded AS ({RECORDED}),
replied AS (SELECT *, extraction_run_id || '-' || page_number AS request_id, l_suppkey % 100 AS s,
    'Land ' || (l_suppkey % 25) AS land FROM recorded)"""
ORACLES["reply_violations"] = f"""
WITH {REPLIED} SELECT CASE s WHEN 14 THEN 'Z' ELSE '' END || request_id AS request_id,
  CASE s WHEN 1 THEN 'quote_absent' WHEN 2 THEN 'quote_ambiguous'
  WHEN 3 THEN 'page_not_selected' WHEN 4 THEN 'fields_not_covered' WHEN 5 THEN 'candidate_incomplete'
  WHEN 11 THEN 'raw_value_not_text' WHEN 12 THEN 'pages_not_unique'
  WHEN 13 THEN 'pages_page_outside_document' WHEN 14 THEN 'request_unknown' WHEN 15 THEN 'unknown_key'
  ELSE 'reply_invalid' END AS rule FROM replied WHERE s BETWEEN 1 AND 6 OR s BETWEEN 11 AND 15
"""
ORACLES["reply_observations"] = f"""
WITH {REPLIED} SELECT request_id, 0 AS observation_index, 'country' AS field_name,
  CASE s WHEN 7 THEN 'int' WHEN 8 THEN 'double' WHEN 10 THEN 'bool' ELSE 'string' END AS value_type,
  CASE s WHEN 7 THEN '12' WHEN 8 THEN '12.0' WHEN 9 THEN '"12"' WHEN 10 THEN 'true'
    ELSE '"' || land || '"' END AS value_json, NULL AS missing_reason,
  instr(text, 'Host country: ' || land) - 1 AS char_start
FROM replied WHERE s NOT BETWEEN 1 AND 6 AND s NOT BETWEEN 11 AND 15 UNION ALL
SELECT request_id, 1, 'validator_name', NULL, NULL, 'not_found', NULL
FROM replied WHERE s NOT BETWEEN 1 AND 6 AND s NOT BETWEEN 11 AND 15
"""
ORACLES["extractor_union"] = f"""
SELECT e AS extractor_name, field_name, count(*) AS observations
FROM ({RECORDED}) CROSS JOIN (VALUES ('regex'), ('reply')) AS extractors(e) GROUP BY 1, 2
"""

# ------------------------------------------------------------------------------- discovery
_OPEN = r"(?is)<a\s([^>]*)>(.*?)</a\s*>"
ORACLES["html_links"] = rf"""
WITH bodies AS (SELECT page_id, url, regexp_replace(html,
    '(?is)<!--.*?-->|<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>', '', 'g') AS body
  FROM pages),
anchors AS (SELECT page_id, url, unnest(range(1, len(a) + 1)) AS n, a, t
  FROM (SELECT *, regexp_extract_all(body, '{_OPEN}', 1) AS a,
    regexp_extract_all(body, '{_OPEN}', 2) AS t FROM bodies)),
links AS (SELECT page_id, url, n,
    replace(replace(regexp_extract(a[n], '(?i)href="([^"]*)"', 1), '&quot;', '"'), '&amp;', '&')
      AS href,
    trim(replace(regexp_replace(t[n], '(?:<[^>]*>)+', ' ', 'g'), '&amp;', '&')) AS label FROM anchors)
SELECT 'acr-' || page_id || '-' || n AS document_id,
  CASE WHEN label <> '' THEN label ELSE list_last(string_split(href, '/')) END AS title,
  CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS url
FROM links WHERE contains(lower(href), 'th') OR contains(lower(label), 'th')
"""
ORACLES["grouped_json_documents"] = """
SELECT source AS project_id, CAST(doc_id AS VARCHAR) AS document_id, 'Report ' || lang AS title,
  'https://registry.verra.org/files/' || doc_id || '.pdf' AS url,
  CAST(doc_id % 3 AS VARCHAR) AS declared_version FROM documents
UNION ALL SELECT source, '/abs/' || lang, '/abs/' || lang,
  'https://registry.verra.org/abs/' || lang, NULL FROM documents
"""
ORACLES["requested_json_documents"] = """
WITH found AS (SELECT source AS project_id, CAST(doc_id AS VARCHAR) AS document_id,
    'Doc ' || lang AS title FROM documents
  UNION ALL SELECT source, 'x' || doc_id, 'x' || doc_id FROM documents)
SELECT *, 'https://assurance-platform.goldstandard.org/api/public/documents/' || document_id
  || '/download' AS url FROM found
"""
ORACLES["response_classes"] = f"""
WITH r AS ({local(adapters.RESPONSES)}),
classed AS (SELECT *, http_status BETWEEN 200 AND 299 AS fine,
  contains(lower(body), '404 not found') OR contains(lower(body), 'invalid page') AS lost FROM r)
SELECT page_id, octet_length(encode(body)) AS body_bytes,
  CASE WHEN http_status IS NULL THEN 'transport_failure' WHEN http_status = 404 THEN 'not_found'
    WHEN http_status = 429 THEN 'rate_limited' WHEN http_status >= 500 THEN 'transient_failure'
    WHEN NOT fine THEN 'blocked' WHEN page_id % 5 = 0 THEN 'ok'
    WHEN page_id % 5 IN (1, 2) AND lost THEN 'not_found' ELSE 'endpoint_mismatch' END AS status,
  CASE WHEN http_status IS NULL THEN 'network_error' WHEN NOT fine THEN 'http_' || http_status
    WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 5 = 3 THEN 'invalid_json'
    WHEN page_id % 5 = 4 THEN 'unexpected_content_type' WHEN lost THEN 'html_not_found'
    ELSE 'html_instead_of_data' END AS error_code
FROM classed
"""
SYNC = f"""runs AS ({local(adapters.SYNC_RUNS)}), failures AS ({local(adapters.SYNC_FAILURES)}),
failed AS (SELECT sync_run_id, count(*) AS n, bool_or(scope = 'registry') AS whole
  FROM failures GROUP BY 1),
stated AS (SELECT r.*, coalesce(n, 0) AS failures, CASE WHEN n IS NULL THEN 'succeeded'
    WHEN whole THEN 'failed' WHEN discovered_projects > 0 THEN 'partial' ELSE 'failed' END AS status,
    CASE WHEN n IS NULL THEN next_cursor ELSE cursor_before END AS cursor_after
  FROM runs r LEFT JOIN failed f USING (sync_run_id))"""
ORACLES["sync_run_status"] = f"""
WITH {SYNC} SELECT sync_run_id, status, failures, cursor_after FROM stated
"""
ORACLES["sync_ledger"] = f"""
WITH {SYNC} SELECT registry, arg_max(sync_run_id, (finished_at, sync_run_id)) AS last_run_id,
  arg_max(status, (finished_at, sync_run_id)) AS last_status,
  arg_max(cursor_after, (finished_at, sync_run_id)) AS cursor, count(*) AS runs
FROM stated GROUP BY 1
"""

# ------------------------------------------------------------------------------- contracts


def _checks(table: str, key: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", {key} AS key, '{rule}' AS rule FROM ({source}) WHERE {bad}"
        for rule, bad in rules.items()
    )


ORACLES["contract_evidence"] = _checks(
    "evidence",
    "parsed_document_id || '/' || observation_index",
    f"""SELECT *, CASE WHEN l_suppkey % 7 = 0 THEN char_start ELSE char_end END AS e
    FROM ({RECORDED})""",
    {
        "offsets_both_or_none": "(char_start IS NULL) <> (e IS NULL)",
        "end_after_start": "e <= char_start",
        "page_positive": "evidence_page - 100000 < 1",
        "quote_not_empty": "coalesce(quote, '') = ''",
    },
)
_KEPT = f"SELECT * FROM ({LINES})"
ORACLES["contract_pages"] = _checks(
    "parsed_pages",
    "parsed_document_id || '/' || page_number",
    _KEPT,
    {"offsets_span_text": "page_number = 3"},
) + f""" UNION ALL SELECT 'parsed_pages', CAST(parsed_document_id AS VARCHAR), 'pages_sequential'
FROM ({_KEPT}) GROUP BY parsed_document_id HAVING max(page_number) >= 7"""
ORACLES["contract_runs"] = _checks(
    "processing_runs",
    "CAST(event_id AS VARCHAR)",
    """SELECT *, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running'
    ELSE 'succeeded' END AS status FROM events""",
    {
        "finish_after_start": "event_id % 3 <> 0 AND event_id % 2 = 1",
        "running_without_finish": "(status = 'running') <> (event_id % 3 = 0)",
        "failed_with_error": "status = 'failed' AND event_id % 10 <> 0",
        "error_only_when_failed": "status <> 'failed' AND event_id % 5 = 0",
        "stage_known": "event_id % 50 = 0",
    },
)
ORACLES["contract_observations"] = _checks(
    "observations",
    "extraction_run_id || '/' || observation_index",
    f"""SELECT *, CASE WHEN observation_index % 101 <> 0 THEN raw_value END AS kept
    FROM ({RECORDED})""",
    {
        "candidate_has_value_and_evidence": "raw_value IS NOT NULL AND kept IS NULL",
        "evidence_of_own_version": "raw_value IS NOT NULL AND evidence_version <> document_version_id",
        "field_known": f"observation_index % 103 = 0 OR field_name NOT IN ({quoted(FIELDS)})",
        "confidence_in_range": "confidence * 1.2 > 1",
    },
)
ORACLES["contract_validation"] = f"""
WITH {VALIDATED}, spoiled AS (SELECT *, status AS true_status,
    CASE WHEN observation_index % 107 = 0 THEN 'missing' ELSE status END AS now FROM checks)
SELECT 'validation_reports' AS "table", extraction_run_id || '/' || observation_index AS key,
  'rejected_with_error' AS rule FROM spoiled WHERE (now = 'rejected') <> (true_status = 'rejected')
UNION ALL SELECT 'validation_reports', extraction_run_id || '/' || observation_index,
  'missing_is_abstention' FROM spoiled WHERE now = 'missing' AND raw_value IS NOT NULL
UNION ALL SELECT 'validation_reports', extraction_run_id, 'indices_sequential' FROM spoiled
GROUP BY extraction_run_id HAVING min(observation_index) <> 0
  OR max(observation_index) <> count(*) - 1
"""
ORACLES["contract_consistency"] = f"""
WITH recorded AS ({RECORDED})
SELECT 'consistency' AS "table", validation_run_id || '/' || (-observation_index - 1)
  || '/cross_version_difference' AS key, 'link_resolves' AS rule
FROM recorded WHERE observation_index % 109 = 0
UNION ALL SELECT 'consistency', validation_run_id || '/' || observation_index
  || '/cross_version_difference', 'link_field_in_issue'
FROM recorded WHERE observation_index % 109 <> 0 AND observation_index % 113 = 0
  AND field_name NOT IN ('country', 'project_name')
"""
ORACLES["contract_review"] = _checks(
    "review_requests",
    "decision_id",
    local(adapters.EVENT_DECISIONS),
    {
        "reviewer_not_blank": "event_id % 31 = 0",
        "approval_with_authority_and_value": "event_id % 37 = 0 AND status = 'approved'",
        "value_only_with_approval": "event_id % 37 = 0 AND status <> 'approved'",
    },
)
ORACLES["contract_judgments"] = _checks(
    "judgments",
    "request_id || '/' || criterion_id",
    f"SELECT *, {adapters.JUDGMENT_OUTCOME} AS outcome FROM ({local(adapters.JUDGED)})",
    {
        "criterion_known": "criterion_id = 'D13.C1'",
        "reason_not_blank": "request_id % 41 = 0",
        "facts_distinct": "request_id % 3 <> 0 AND request_id % 43 = 0",
        "decisive_needs_basis":
            "request_id % 3 = 0 AND outcome IN ('supported', 'not_supported', 'not_applicable')",
    },
)
ORACLES["contract_evaluations"] = f"""
WITH {JUDGED}, kept AS (SELECT * REPLACE (CASE WHEN request_id % 47 = 0 AND dimension_id = 'D05'
    THEN 'D99' ELSE dimension_id END AS dimension_id) FROM coverage)
SELECT 'evaluation_results' AS "table", request_id || '/' || dimension_id AS key,
  'coverage_is_partition' AS rule FROM kept
  WHERE CASE WHEN dimension_id = 'D99' THEN request_id % 53 <> 0 OR reviewed_criterion_ids <> ''
    ELSE request_id % 53 = 0 END
UNION ALL SELECT DISTINCT 'evaluation_results', CAST(request_id AS VARCHAR),
  'exactly_twelve_dimensions' FROM kept WHERE request_id % 47 = 0
"""
ORACLES["contract_contexts"] = _checks(
    "assessment_context",
    "'verra/P' || c_custkey",
    "SELECT * FROM customer",
    {
        "period_is_calendar_date": "c_custkey % 16 = 1",
        "period_in_order": "c_custkey % 18 = 1 AND c_custkey % 16 <> 1",
        "reason_not_blank": "c_custkey % 40 = 1",
    },
)
ORACLES["contract_policies"] = _checks(
    "scoring_policy",
    "CAST(s_suppkey AS VARCHAR)",
    "SELECT *, s_suppkey % 2 = 0 AS approved, s_suppkey % 11 = 0 AS eleven FROM supplier",
    {
        "twelve_distinct_dimensions": "eleven",
        "approved_has_all_weights": "approved AND s_suppkey % 7 = 0",
        # A policy that keeps ten of eleven weights of 0.1 does add up to one.
        "approved_weights_sum_to_one":
            "approved AND (eleven OR s_suppkey % 7 = 0 OR s_suppkey % 3 = 0) "
            "AND s_suppkey % 231 <> 0",
        "approved_has_authority": "approved AND s_suppkey % 5 = 0",
    },
)
_LABELS = f"""SELECT *, n % 59 = 0 AS pending, CASE WHEN n % 61 = 0 THEN 'test' ELSE split END AS s,
  n % 59 <> 0 AND sample_status = 'frozen' AS frozen
FROM (SELECT *, CAST(substr(sample_id, 2) AS BIGINT) AS n FROM ({local(adapters.GOLD_LABELS)}))"""
ORACLES["contract_gold"] = _checks(
    "gold_labels",
    "dataset_version || '/' || sample_id || '/' || field_name",
    _LABELS,
    {
        "confirmed_has_value_and_evidence": "label_status = 'confirmed' AND value_json IS NULL",
        "frozen_needs_two_reviewers": "frozen AND n % 67 = 0",
        "frozen_needs_adjudicator": "frozen AND n % 71 = 0",
    },
) + f""" UNION ALL SELECT DISTINCT 'gold_samples', dataset_version || '/' || sample_id,
  'adjudication_needs_conflict' FROM ({_LABELS}) WHERE pending
UNION ALL SELECT 'gold_samples', dataset_version || '/' || project_id, 'project_in_one_split'
FROM ({_LABELS}) GROUP BY dataset_version, project_id HAVING count(DISTINCT s) > 1"""
_ARRIVED_VERSIONS = local(adapters.ARRIVALS)
ORACLES["contract_versions"] = _checks(
    "document_versions",
    "file_name",
    _ARRIVED_VERSIONS,
    {"sha256_valid": "byte_size % 10 = 0", "byte_size_positive": "byte_size <= 100"},
) + f""" UNION ALL SELECT 'document_versions', registry_project_id || '/' || h,
  'content_once_per_source' FROM (SELECT registry_project_id,
    CASE WHEN byte_size % 10 = 0 THEN upper(sha256) ELSE sha256 END AS h FROM ({_ARRIVED_VERSIONS}))
GROUP BY registry_project_id, h HAVING count(*) > 1"""

# --------------------------------------------------------------------- tables and streams
ORACLES["idempotent_append"] = """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'reused' WHEN 1 THEN 'conflict' ELSE 'written' END
  AS result FROM customer
"""
ORACLES["streamed_versions"] = f"""
WITH {ARRIVED}, first_title AS (SELECT source_document_id,
  arg_min(title, (retrieved_at, file_name)) AS first_title FROM arrived GROUP BY 1)
SELECT DISTINCT source_document_id,
  {uuid5_sql("'version:' || source_document_id || ':' || sha256")} AS document_version_id, sha256
FROM arrived JOIN first_title USING (source_document_id) WHERE title = first_title
"""
ORACLES["streamed_heads"] = ORACLES["canonical_heads"]
