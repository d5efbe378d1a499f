"""SQL equivalents of the queries in ``lineage_queries``."""

from __future__ import annotations

from attestry.catalog import APPROVAL_TOLERATES, DIMENSION_INPUTS, EXTRACTION_RULES, FIELDS, REGISTRIES
from attestry.plans.lineage_queries import PLANT_FIELDS, PLANT_RULES
from attestry.plans.oracles import (
    CARBON,
    CODES,
    GROUNDED,
    LINES,
    ORACLES,
    RECORDED,
    TYPED,
    extraction_sql,
    local,
    quoted,
    uuid5_sql,
)
from attestry.plans.review_oracles import FOLD, IDENTITY
from attestry.sources import adapters

# ----------------------------------------------------------------------------- stored pages
ORACLES["stored_grounding"] = ORACLES["evidence_grounding"]
ORACLES["stored_page_counts"] = f"""
SELECT parsed_document_id, count(*) AS pages, sum(length(text)) AS characters FROM ({RECORDED}) GROUP BY 1
"""

# ----------------------------------------------------------------------------- extraction
_COLUMNS = """parsed_document_id, observation_index, field_name, raw_value, value_json, unit, missing_reason,
  page_number, char_start, char_end, quote"""


def _extracted(pages: str, columns: str = _COLUMNS, rules=EXTRACTION_RULES, fields=FIELDS) -> str:
    return f"WITH {extraction_sql(pages, rules, fields)} SELECT {columns} FROM extracted"


_DOCUMENTS = "SELECT doc_id AS parsed_document_id, 1 AS page_number, text FROM documents"
_TURNS = "SELECT conv_id AS parsed_document_id, turn AS page_number, text FROM conversations"
ORACLES["document_extraction"] = _extracted(_DOCUMENTS, f"{_COLUMNS}, issues")
ORACLES["turn_extraction"] = _extracted(_TURNS, f"{_COLUMNS}, issues")
ORACLES["rule_set_extraction"] = f"""
SELECT 'catalog' AS rule_set, * FROM ({_extracted(CARBON)})
UNION ALL SELECT 'plant', * FROM ({_extracted(CARBON, rules=PLANT_RULES, fields=PLANT_FIELDS)})
"""
_CHOICE = f"""recorded AS ({RECORDED}),
key AS (SELECT parsed_document_id, page_number, CAST(substr(parsed_document_id, 2) AS BIGINT) AS n FROM recorded),
choice AS (SELECT parsed_document_id, CASE WHEN n % 11 = 0 THEN -page_number ELSE page_number END AS page_number
  FROM key UNION ALL SELECT parsed_document_id, page_number FROM key WHERE n % 13 = 0 AND page_number % 2 = 0),
refused AS (SELECT c.parsed_document_id, c.page_number, 'page_unknown' AS rule FROM choice c
    ANTI JOIN key k ON k.parsed_document_id = c.parsed_document_id AND k.page_number = c.page_number
  UNION SELECT parsed_document_id, page_number, 'page_repeated' FROM choice GROUP BY 1, 2 HAVING count(*) > 1)"""
ORACLES["page_subset_refusals"] = f"WITH {_CHOICE} SELECT * FROM refused"
_CHOSEN = f"""{CARBON} WHERE parsed_document_id NOT IN (
  SELECT parsed_document_id FROM (WITH {_CHOICE} SELECT * FROM refused))"""
ORACLES["chosen_page_extraction"] = ORACLES["extraction_summary"].replace(
    extraction_sql(CARBON), extraction_sql(_CHOSEN)
)

# -------------------------------------------------------------------------- foreign extractors
_FOREIGN = r"""named AS (SELECT *, doc_id % 10 AS f, CAST(doc_id AS VARCHAR) AS id, text = '' AS blank,
    substr(text, 1, 12) AS name FROM documents WHERE text IS NOT NULL),
refusals AS (
  SELECT id AS parsed_document_id, 'evidence_quote_missing' AS rule FROM named
    WHERE NOT blank AND f <> 7 AND (f = 1 OR f <> 6 AND regexp_full_match(name, '\s+'))
  UNION SELECT id, 'evidence_offsets_mismatch' FROM named WHERE f = 2 AND NOT blank
    AND (1 + length(name) > length(text) OR substr(text, 2, length(name)) <> name)
  UNION SELECT id, 'field_known' FROM named WHERE f = 3
  UNION SELECT id, 'candidate_has_value_and_evidence' FROM named WHERE f = 4 AND NOT blank
  UNION SELECT id, 'index_not_sequential' FROM named WHERE f = 5
  UNION SELECT id, 'evidence_page_missing' FROM named WHERE f = 6 AND NOT blank
  UNION SELECT 'Z' || id, 'document_unknown' FROM named WHERE f = 7
  UNION SELECT 'Z' || id, 'evidence_page_missing' FROM named WHERE f = 7 AND NOT blank
  UNION SELECT id, 'confidence_in_range' FROM named WHERE f = 8),
kept AS (SELECT * FROM named WHERE f <> 7 AND id NOT IN (SELECT parsed_document_id FROM refusals))"""
ORACLES["external_refusals"] = f"WITH {_FOREIGN} SELECT * FROM refusals"
ORACLES["external_extraction"] = f"""
WITH {_FOREIGN} SELECT id AS parsed_document_id, 'X' || id AS extraction_run_id, 0 AS observation_index,
  'project_name' AS field_name, CASE WHEN NOT blank THEN name END AS raw_value,
  CASE WHEN blank THEN 'not_found' END AS missing_reason,
  CASE WHEN NOT blank THEN length(name) + CASE f WHEN 2 THEN 1 ELSE 0 END END AS char_end FROM kept
UNION ALL SELECT id, 'X' || id, 1, 'country', NULL, 'not_found', NULL FROM kept
"""

# --------------------------------------------------------------------------------- refusals
_FAULTS = (
    (1, "run_not_succeeded"), (2, "run_stage_differs"), (3, "input_hash_differs"), (4, "run_identity_differs"),
    (5, "document_version_id_differs"), (6, "registry_differs"), (7, "project_id_differs"),
    (8, "configuration_differs"), (8, "fields_not_covered"), (9, "configuration_differs"),
    (9, "selected_pages_hash_differs"), (10, "selected_pages_hash_differs"),
)
ORACLES["comparison_refusals"] = f"""
WITH {GROUNDED}, faults(f, rule) AS (VALUES {", ".join(f"({n}, '{rule}')" for n, rule in _FAULTS)})
, sizes AS (SELECT l_orderkey, count(*) > 8 OR sum(length(text)) > 24000 AS large FROM recorded GROUP BY 1)
SELECT l_orderkey AS request_id, rule FROM sizes JOIN faults ON f = l_orderkey % 32
WHERE NOT (large AND rule = 'selected_pages_hash_differs')
UNION ALL SELECT l_orderkey, 'pages_not_selectable' FROM sizes WHERE large
UNION ALL SELECT DISTINCT l_orderkey, 'evidence_not_located' FROM outcomes WHERE outcome <> 'grounded'
"""
_LINE = "json_extract_string(value, '$.{0}')"
_PATH, _SHA, _TYPE, _URL, _REGISTRY = (
    _LINE.format(x) for x in ("relative_path", "sha256", "content_type", "source_url", "registry")
)
_SIZE = "CAST(json_extract_string(value, '$.size_bytes') AS BIGINT)"
ORACLES["manifest_line_violations"] = f"""
WITH lines AS (SELECT value FROM ({local(adapters.MANIFEST_LINES)}) WHERE trim(value) <> ''),
kinds AS (SELECT *, CASE WHEN NOT json_valid(value) THEN 'broken' WHEN json_type(value) <> 'OBJECT' THEN 'broken'
    WHEN json_type(value, '$.size_bytes') = 'VARCHAR' THEN 'broken'
    WHEN json_type(value, '$.row_count') IS NOT NULL THEN 'header' ELSE 'row' END AS kind FROM lines),
rows AS (SELECT * FROM kinds WHERE kind = 'row'), headers AS (SELECT * FROM kinds WHERE kind = 'header'),
found AS (
  SELECT value, 'line_broken' AS rule FROM kinds WHERE kind = 'broken'
  UNION ALL SELECT value, 'path_empty' FROM rows WHERE {_PATH} = ''
  UNION ALL SELECT value, 'size_not_positive' FROM rows WHERE {_SIZE} <= 0
  UNION ALL SELECT value, 'sha256_invalid' FROM rows WHERE NOT regexp_full_match({_SHA}, '[0-9a-f]{{64}}')
  UNION ALL SELECT value, 'content_type_empty' FROM rows WHERE {_TYPE} = ''
  UNION ALL SELECT value, 'url_not_absolute' FROM rows WHERE NOT regexp_matches({_URL}, '^https?://[^/]+')
  UNION ALL SELECT value, 'registry_unknown' FROM rows WHERE {_REGISTRY} NOT IN ({quoted(REGISTRIES)})
  UNION ALL SELECT value, 'path_repeated' FROM rows WHERE {_PATH} IN (
    SELECT {_PATH} FROM rows GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT value, 'row_count_differs' FROM headers
    WHERE CAST({_LINE.format("row_count")} AS BIGINT) <> (SELECT count(*) FROM rows)
  UNION ALL SELECT value, 'total_bytes_differ' FROM headers
    WHERE CAST({_LINE.format("total_bytes")} AS BIGINT) <> (SELECT sum({_SIZE}) FROM rows))
SELECT sha256(value) AS line, rule FROM found
"""

# ------------------------------------------------------------------------------- whole chain
_KINDS = {rule.field: rule.kind for rule in EXTRACTION_RULES}
_VALUE_TYPE = "CASE " + " ".join(
    f"WHEN field_name IN ({quoted([f for f, k in _KINDS.items() if k == kind])}) THEN '{name}'"
    for kind, name in (("number", "double"), ("integer", "int"))
) + " ELSE 'string' END"
_INPUTS = ", ".join(
    f"('{d}', {n}, '{f}')" for d, fields in DIMENSION_INPUTS.items() for n, f in enumerate(fields)
)
_CHAIN = f"""{extraction_sql(CARBON)}, {IDENTITY},
found AS (SELECT e.*, r.registry, r.project_id, r.extraction_run_id, r.validation_run_id,
    {_VALUE_TYPE} AS value_type, NULL::DOUBLE AS confidence
  FROM extracted e JOIN i_reports r USING (parsed_document_id)),
kinds AS (SELECT extraction_run_id, field_name,
    count(DISTINCT value_json || '|' || coalesce('u' || unit, '-')) AS held
  FROM found WHERE missing_reason IS NULL GROUP BY 1, 2),
typed AS (SELECT f.*, {TYPED} AS typed, try_cast(CASE WHEN value_type <> 'string' THEN value_json END AS DOUBLE)
    AS number, 1 AS kinds FROM found f WHERE missing_reason IS NULL),
coded AS (SELECT *, concat_ws(',', {CODES}) AS own_codes FROM typed),
open AS (SELECT * FROM coded WHERE NOT regexp_matches(own_codes, 'field_type|numeric_range|calendar')
    AND validation_run_id NOT IN (SELECT validation_run_id FROM identity)),
first AS (SELECT registry, project_id, field_name, min((validation_run_id, observation_index)) AS o
  FROM open GROUP BY 1, 2, 3),
approved AS (SELECT o.*, {uuid5_sql("'candidate:' || o.validation_run_id || ':' || o.observation_index")} AS candidate_id
  FROM open o JOIN first f ON f.registry = o.registry AND f.project_id = o.project_id
    AND f.field_name = o.field_name AND f.o[1] = o.validation_run_id AND f.o[2] = o.observation_index
  WHERE len(list_filter(string_split(own_codes, ','), lambda c: c NOT IN ({quoted(APPROVAL_TOLERATES)}))) = 0),
facts AS (SELECT a.*, {uuid5_sql("'fact:approve:' || candidate_id")} AS fact_id, v.source_document_id, v.sha256
  FROM approved a JOIN i_parsed p ON p.parsed_document_id = a.parsed_document_id
  JOIN i_versions v ON v.document_version_id = p.document_version_id
  JOIN i_sources s ON s.source_document_id = v.source_document_id)"""
ORACLES["end_to_end_facts"] = f"""
WITH {_CHAIN} SELECT registry, project_id, field_name, value_json, unit, fact_id, candidate_id, extraction_run_id,
  source_document_id, sha256 FROM facts
"""
ORACLES["end_to_end_readiness"] = f"""
WITH {_CHAIN}, inputs(dimension_id, n, field_name) AS (VALUES {_INPUTS}),
projects AS (SELECT registry, registry_project_id AS project_id FROM i_sources UNION SELECT registry, project_id FROM facts),
scopes AS (SELECT registry, project_id, bool_or(field_name = 'methodology_name' AND value_json = '"ACM0002"') AS scope
  FROM facts GROUP BY 1, 2),
listed AS (SELECT p.registry, p.project_id, i.dimension_id,
    coalesce(string_agg(i.field_name, ',' ORDER BY i.n) FILTER (f.fact_id IS NOT NULL), '') AS available_fields,
    coalesce(string_agg(i.field_name, ',' ORDER BY i.n) FILTER (f.fact_id IS NULL), '') AS missing_fields,
    coalesce(string_agg(f.fact_id, ',' ORDER BY i.n) FILTER (f.fact_id IS NOT NULL), '') AS fact_ids
  FROM projects p CROSS JOIN inputs i LEFT JOIN facts f ON f.registry = p.registry
    AND f.project_id = p.project_id AND f.field_name = i.field_name GROUP BY 1, 2, 3)
SELECT l.*, CASE WHEN coalesce(s.scope, false) THEN 'confirmed_by_reviewed_fact'
    ELSE 'unconfirmed_or_out_of_scope' END AS methodology_scope,
  CASE WHEN missing_fields = '' THEN 'rubric_pending' ELSE 'missing_inputs' END AS status
FROM listed l LEFT JOIN scopes s ON s.registry = l.registry AND s.project_id = l.project_id
"""

# ------------------------------------------------------------------- decisions and contracts
ORACLES["decision_replays"] = f"""
WITH {FOLD}, base AS (SELECT decision_id, CASE WHEN code = '' THEN status ELSE 'blocked' END AS outcome, code,
    CAST(substr(decision_id, 2) AS BIGINT) AS n, status FROM decided),
sent AS (SELECT decision_id, outcome, code AS codes FROM base
  UNION ALL SELECT decision_id, CASE WHEN code = '' THEN 'reused' ELSE 'blocked' END, code FROM base WHERE n % 7 = 0
  UNION ALL SELECT decision_id, 'blocked', 'decision_id_conflict' FROM base WHERE n % 11 = 0
  UNION ALL SELECT 'N' || decision_id, 'blocked', 'candidate_not_found' FROM base WHERE status = 'approved' AND n % 13 = 0
  UNION ALL SELECT 'M' || decision_id, 'blocked', 'replacement_field_mismatch' FROM base
    WHERE status = 'approved' AND n % 17 = 0
  UNION ALL SELECT 'A' || decision_id, 'blocked', 'parsed_document_absent' FROM base
    WHERE status = 'approved' AND n % 19 = 0)
SELECT decision_id, outcome, codes, count(*) AS submissions FROM sent GROUP BY 1, 2, 3
"""
ORACLES["contract_parsed"] = f"""
WITH lines AS (SELECT parsed_document_id, max(page_number) >= 3 AS used FROM ({LINES}) GROUP BY 1),
documents_of AS (SELECT d.doc_id AS id, l.used, d.doc_id % 5 <> 0 AS named, d.doc_id % 7 <> 0 AS versioned
  FROM documents d LEFT JOIN lines l ON l.parsed_document_id = d.doc_id)
SELECT 'parsed_documents' AS "table", CAST(id AS VARCHAR) AS key, 'engine_name_with_version' AS rule
  FROM documents_of WHERE named <> versioned
UNION ALL SELECT 'parsed_documents', CAST(id AS VARCHAR), 'ocr_pages_need_engine' FROM documents_of
  WHERE coalesce(used, false) AND NOT named
UNION ALL SELECT 'parsed_documents', CAST(id AS VARCHAR), 'has_pages' FROM documents_of WHERE used IS NULL
"""
_ARRIVED = f"(SELECT *, CAST(regexp_extract(registry_project_id, '([0-9]+)', 1) AS BIGINT) AS n FROM ({local(adapters.ARRIVALS)}))"
ORACLES["contract_sources"] = f"""
WITH sources AS (SELECT DISTINCT registry_project_id AS id, n FROM {_ARRIVED}),
faults(rule, d) AS (VALUES ('registry_known', 3), ('document_type_known', 5), ('project_present', 7), ('url_absolute', 11))
SELECT 'source_documents' AS "table", id AS key, rule FROM sources JOIN faults ON n % d = 0
UNION ALL SELECT 'document_versions', file_name, 'source_exists' FROM {_ARRIVED} WHERE n % 19 = 0
"""
ORACLES["contract_datasets"] = f"""
WITH labels AS (SELECT *, CASE WHEN CAST(substr(sample_id, 2) AS BIGINT) % 41 = 0 THEN 'unlisted'
    ELSE dataset_version END AS named FROM ({local(adapters.GOLD_LABELS)})),
samples AS (SELECT named, sample_id, bool_or(sample_status <> 'frozen') AS open FROM labels GROUP BY 1, 2)
SELECT 'gold_datasets' AS "table", 'verra' AS key, 'frozen_dataset_needs_time' AS rule
  WHERE EXISTS (SELECT 1 FROM labels WHERE dataset_version = 'verra')
UNION ALL SELECT 'gold_samples', named || '/' || sample_id, 'frozen_dataset_needs_frozen_samples' FROM samples
  WHERE open AND named NOT IN ('acr', 'unlisted')
UNION ALL SELECT 'gold_samples', named || '/' || sample_id, 'dataset_version_known' FROM samples WHERE named = 'unlisted'
"""
